"""DuckDB SQL for the rows of the queries."""

EXACT_COPIES = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

_BLOCK, _ROOT = 64, 64
_PICKED = "((({p}) + first) * picked // blocks - first * picked // blocks)"
_BLOCK_OF = "(({w}) // " + str(_BLOCK) + ")"


def _taken(words: str) -> str:
    block = _BLOCK_OF.format(w=words)
    before, after = _PICKED.format(p=block), _PICKED.format(p=block + " + 1")
    return f"(rounds * ({words}) + least(rest, {_BLOCK} * {before} + (({words}) % {_BLOCK}) * ({after} - {before})))"


MIX = f"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5(concat('mix:', coalesce(doc_id::VARCHAR, ''))) AS ticket
    FROM documents
), s AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap, list_extract([3, 1, 2], ((source_no - 1) % 3 + 1)::BIGINT) AS weight,
           greatest(1, ceil(sqrt(source_size) / {_ROOT}))::BIGINT AS shards
    FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_no
          FROM d GROUP BY source)
), l AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER r - cap)) / sum(weight) OVER f AS level
    FROM s WINDOW r AS (ORDER BY cap / weight, source_no ROWS UNBOUNDED PRECEDING),
                  f AS (ORDER BY cap / weight, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), t AS (
    SELECT *, coalesce(least(cap, (SELECT level FROM l WHERE cap / weight > level ORDER BY cap / weight, source_no LIMIT 1)
                                  * weight), cap) AS target
    FROM l
), seat_count AS (SELECT round(sum(target) / {_BLOCK})::BIGINT AS seats FROM t
), source_seats AS (
    SELECT source_no, count(k) AS quota FROM (
        SELECT source_no, k, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source_no, k) AS n
        FROM t, seat_count, generate_series(1, seats) AS g(k) WHERE target > 0)
    WHERE n <= (SELECT seats FROM seat_count) GROUP BY source_no
), p AS (
    SELECT d.*, t.source_no, t.source_size, t.target, ('0x' || substr(ticket, 1, 8))::BIGINT % shards AS shard
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), h AS (SELECT source_no, shard, sum(size)::DOUBLE AS votes FROM p GROUP BY ALL
), shard_seats AS (
    SELECT source_no, shard, count(*) AS won FROM (
        SELECT source_no, shard, quota,
               row_number() OVER (PARTITION BY source_no ORDER BY votes / (2 * k - 1) DESC, shard, k) AS n
        FROM h JOIN source_seats USING (source_no), generate_series(1, quota) AS g(k) WHERE votes > 0)
    WHERE n <= quota GROUP BY ALL
), in_blocks AS (
    SELECT h.*, greatest(1, ceil(votes / {_BLOCK}))::BIGINT AS blocks,
           least({_BLOCK} * coalesce(won, 0), 2 * votes::BIGINT)::BIGINT AS in_blocks, target, source_size
    FROM h LEFT JOIN shard_seats USING (source_no, shard) JOIN t USING (source_no)
), in_words AS (
    SELECT *, floor((floor(target + 0.5) - sum(in_blocks) OVER (PARTITION BY source_no))::DOUBLE
                    * (sum(votes) OVER (PARTITION BY source_no ORDER BY shard)) / greatest(source_size, 1))::BIGINT AS settled
    FROM in_blocks
), words AS (
    SELECT source_no, shard, votes::BIGINT AS shard_size, blocks,
           greatest(0, least(in_blocks + settled - coalesce(lag(settled) OVER (PARTITION BY source_no ORDER BY shard), 0),
                             2 * votes::BIGINT))::BIGINT AS quota
    FROM in_words
), q AS (
    SELECT source_no, shard, blocks, quota // greatest(shard_size, 1) AS rounds, quota % greatest(shard_size, 1) AS rest,
           CASE WHEN quota % greatest(shard_size, 1) > 0
                THEN least(blocks, ceil((quota % greatest(shard_size, 1)) / {_BLOCK}::DOUBLE)::BIGINT + 1) ELSE 0 END AS picked,
           ('0x' || substr(md5(concat('mix:', source_no, ':', shard)), 1, 8))::BIGINT % blocks AS first
    FROM words
), o AS (
    SELECT p.*, q.blocks, q.first, q.rounds, q.rest, q.picked,
           (sum(size) OVER (PARTITION BY source_no, shard ORDER BY ticket, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS until
    FROM p JOIN q USING (source_no, shard)
)
SELECT doc_id, size, source_size, target, {_taken("until")} - {_taken("(until - size)")} AS taken FROM o
"""


def _round(number: int) -> str:
    """Assignment to the centroids of a round, and those of the next."""
    return f"""
n{number} AS (
    SELECT vec_id, arg_min(cluster, struct_pack(distance, cluster)) AS cluster, min(distance) AS distance
    FROM (SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
          FROM v JOIN c{number} AS c USING (dim) GROUP BY ALL) GROUP BY vec_id
), c{number + 1} AS (
    SELECT cluster, dim, coalesce(m.x, c.x) AS x FROM c{number} AS c
    LEFT JOIN (SELECT cluster, dim, floor(sum(x) / count(*))::BIGINT AS x FROM v JOIN n{number} USING (vec_id) GROUP BY ALL) AS m
    USING (cluster, dim)
)"""


CLUSTERS = f"""
WITH e AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), v AS (
    SELECT vec_id, unnest(range(64)) AS dim, unnest(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT)) AS x FROM e
), c0 AS (
    SELECT cluster, dim, x FROM v JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY sha256(concat('1:', vec_id))) - 1 AS cluster FROM e
        ORDER BY cluster LIMIT 16) USING (vec_id)
), {", ".join(_round(number) for number in range(4))}, names AS (
    SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c3 GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM n3 JOIN names USING (cluster)
"""


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"CASE WHEN ({f}) IS NULL THEN '-' ELSE strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR END" for f in fields) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# the checksum of a short text: each character, then eight shifts by a bit
_STEP = "xor({a} >> 1, CASE WHEN {a} % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END)"
_CRC = f"""xor(list_reduce(
    [4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT] || list_transform(range(8), lambda i: (-1)::BIGINT))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE {_STEP.format(a="a")} END), 4294967295::BIGINT)"""


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels above ``leaves`` (tree, index, total, digest), with level and run."""
    return f"""
{name} AS (
    SELECT tree, 0 AS level, index, total, digest FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, index // 8, (any_value(total) + 7) // 8, sha256(string_agg(digest, '' ORDER BY index))
    FROM {name} WHERE total > 1 GROUP BY tree, level, index // 8
)"""


def _steps(name: str, tree: str) -> str:
    """Siblings of each node: the digests of its run before and after it."""
    return f"""
{name} AS (
    SELECT tree, level, index,
           coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
           coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
    FROM {tree} WHERE total > 1
    WINDOW r AS (PARTITION BY tree, level, index // 8 ORDER BY index)
)"""


MANIFEST = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, CASE WHEN lang IS NULL THEN '-' ELSE '=' || lang END AS tree, {_leaf("text")} AS digest,
           CASE WHEN ({_CRC}) % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS changed
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS index,
           count(*) OVER (PARTITION BY tree) AS total FROM d
), {_tree("nodes", "leaves")}, subroots AS (
    SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS index, count(*) OVER () AS total, digest
    FROM nodes WHERE total = 1
), {_tree("upper", "subroots")}, {_steps("low", "nodes")}, {_steps("high", "upper")}, walk AS (
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, l.changed,
           coalesce((SELECT list(struct_pack(level, lefts, rights) ORDER BY level) FROM low
                     WHERE low.tree = l.tree AND low.index = l.index // pow(8, level)::BIGINT), []) AS inner_path,
           coalesce((SELECT list(struct_pack(level, lefts, rights) ORDER BY level) FROM high
                     WHERE high.index = s.index // pow(8, level)::BIGINT), []) AS outer_path
    FROM leaves AS l JOIN subroots AS s ON s.name = l.tree
), folded AS (
    SELECT *, inner_path || outer_path AS path, (SELECT digest FROM upper WHERE total = 1) AS root,
           list_reduce([struct_pack(a := changed, b := '')] || list_transform(inner_path || outer_path, lambda p: struct_pack(a := p.lefts, b := p.rights)),
                       lambda x, y: struct_pack(a := sha256(y.a || x.a || y.b), b := '')).a AS folded_root
    FROM walk
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda p: p.lefts || p.rights), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
