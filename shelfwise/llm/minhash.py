"""Near copies of documents by BagMinHash of their word shingles.

A text is the multiset of its runs of ``WORDS`` words; fewer words than that are one shingle
as a whole. Two texts are linked when the weighted Jaccard similarity of their multisets, sum
of the lesser over sum of the greater counts, is at least ``SIMILARITY``. Classes are what
links connect.

For signatures the counts of a shingle are dyadic intervals (0-1, 1-2, 2-4, 4-8...), each with
a Poisson process of its own whose rate is the interval's length; a point stands at a level of
its interval, counts for a text whose count is above the level, and falls into one of the
registers. A register keeps its earliest point, so two registers agree with a probability of
exactly the weighted similarity. Points later than all registers need are never made: a text
costs one draw per shingle and interval, and a number of points that does not grow with it.

Texts that agree in a band of registers are compared exactly: first, in a few turns, with one
text of the band's largest class. Texts of bands that still hold several classes are then compared
across classes where they share one of their rarest shingles, without which they cannot be linked.

A missing text is empty. Texts without words are linked with none but identical ones.
Repeated rows and copies belong to one class. A missing id is smaller than any other and
names a class only if nothing else does. An empty table gives an empty result. Names of
other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.tables import columns_of, fresh, ids_and_texts, quoted, whole_text
from shelfwise.llm.wordhash import Texts, chunks, mix, range_hashes, word_hashes
from shelfwise.session import stage, unstage

WORDS = 5
SIMILARITY = (4, 5)  # as a fraction, so comparisons are exact
BANDS, ROWS = 28, 6
REGISTERS = BANDS * ROWS
# one bit of each of the first 128 registers; of two texts at the similarity, one bit in ten differs
# on average, and more than MOST_FLIPS with a probability under 1e-8
SKETCH_LONGS = 2
MOST_FLIPS = 36
# turns in which each bucket compares one text with the others, before the rest are compared exactly
LEADER_TURNS = 2


def shingles(texts: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of every distinct shingle, by text and hash."""
    s, e, first = texts.words()
    hashes = word_hashes(texts, s, e)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(hashes)) - first[owner]
    begins = np.flatnonzero((at + words <= n[owner]) | ((at == 0) & (n[owner] < words)))
    ends = np.minimum(begins + words, first[owner[begins] + 1])
    x = range_hashes(hashes, begins, ends)
    owner = owner[begins]
    order = np.lexsort((x, owner))
    x, owner = x[order], owner[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
    edges = np.append(np.flatnonzero(new), len(x))
    return owner[new], x[new], np.diff(edges)


def _uniform(h: np.ndarray, salt) -> np.ndarray:
    """In (0, 1]."""
    return (mix(h ^ mix(np.asarray(salt, dtype=np.uint64), 12), 11) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def signatures(owner: np.ndarray, x: np.ndarray, count: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """Register values, one row per text; a text without shingles has zeros."""
    # one row for each dyadic interval that begins below the count: 0-1, 1-2, 2-4, ...
    intervals = np.ceil(np.log2(count)).astype(np.int64) + 1 if len(count) else np.zeros(0, np.int64)
    j = np.arange(intervals.sum()) - np.repeat(np.cumsum(intervals) - intervals, intervals)
    owner_of, top = np.repeat(owner, intervals), np.repeat(count, intervals)
    low = np.where(j == 0, 0, 1 << np.maximum(j - 1, 0))
    width = np.maximum(low, 1).astype(np.float64)
    seed = mix(np.repeat(x, intervals) ^ mix(j.astype(np.uint64), 5), 6)
    weight = np.bincount(owner, weights=count, minlength=texts)
    values = np.zeros(texts * registers, dtype=np.uint64)
    open_texts = weight > 0
    patience = 6.0
    while open_texts.any():
        limit = np.where(open_texts, registers / np.maximum(weight, 1) * (np.log(registers) + patience), -1.0)
        times, slots, names = [], [], []
        rows = np.flatnonzero(open_texts[owner_of])
        clock, point, block = np.zeros(len(rows)), 0, 1
        while len(rows):
            h = seed[rows][:, None]
            salt = np.arange(point, point + block)[None, :] * 4
            t = clock[:, None] + np.cumsum(-np.log(_uniform(h, salt)) / width[rows][:, None], axis=1)
            soon = t <= limit[owner_of[rows]][:, None]
            if soon.any():
                r, p = np.nonzero(soon)
                of, at = rows[r], salt[0, p]
                level = low[of] + np.floor((1 - _uniform(seed[of], at + 1)) * width[of])
                counts = level < top[of]
                of, at = of[counts], at[counts]
                slot = (_uniform(seed[of], at + 2) * registers).astype(np.int64) % registers
                times.append(t[r, p][counts])
                slots.append(owner_of[of] * registers + slot)
                names.append(mix(seed[of] ^ mix(at.astype(np.uint64), 7), 8))
            going = soon[:, -1]
            rows, clock = rows[going], t[going, -1]
            point, block = point + block, min(block * 2, 64)
        slots, names, times = np.concatenate(slots), np.concatenate(names), np.concatenate(times)
        earliest = np.full(texts * registers, np.inf)
        np.minimum.at(earliest, slots, times)
        filled = np.isfinite(earliest).reshape(texts, registers).all(axis=1) & open_texts
        first = (times == earliest[slots]) & filled[slots // registers]
        values[slots[first]] = names[first]
        open_texts &= ~filled
        patience *= 2
    return values.reshape(texts, registers)


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key per band; equal keys mean equal registers in the same band."""
    rows = values.reshape(len(values), bands, -1)
    keys = np.zeros(rows.shape[:2], dtype=np.uint64)
    for i in range(rows.shape[2]):
        keys = mix(keys * np.uint64(0x100000001B3) ^ rows[:, :, i], 9)
    return mix(keys ^ np.arange(bands, dtype=np.uint64)[None, :], 10)


def sketch_bits(values: np.ndarray) -> np.ndarray:
    """``SKETCH_LONGS`` numbers per text, with a bit of each register."""
    bits = (values[:, : 64 * SKETCH_LONGS] >> np.uint64(33) & np.uint64(1)).reshape(len(values), SKETCH_LONGS, 64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def overlaps(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of texts the sums of the lesser and of the greater counts."""
    both = []
    for column in (left, right):
        parts = [[np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]]
        for texts in chunks(column):
            owner, x, count = shingles(texts)
            for part, got in zip(parts, (owner + texts.first, x, count)):
                part.append(got)
        both.append([np.concatenate(p) for p in parts])
    owner, x, count = (np.concatenate([a, b]) for a, b in zip(*both))
    order = np.lexsort((x, owner))
    owner, x, count = owner[order], x[order], count[order]
    same = np.flatnonzero((x[1:] == x[:-1]) & (owner[1:] == owner[:-1]))
    less = np.bincount(owner[same], weights=np.minimum(count[same], count[same + 1]), minlength=len(left)).astype(np.int64)
    total = np.bincount(owner, weights=count, minlength=len(left)).astype(np.int64)
    return less, total - less


def _sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, weight, bits, bands) of (doc_id, text)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                n = len(texts.offsets) - 1
                owner, x, count = shingles(texts)
                values = signatures(owner, x, count, n)
                keys, bits = band_keys(values), sketch_bits(values)
                part = batch.slice(texts.first, n)
                weight = np.bincount(owner, weights=count, minlength=n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("digest"),
                        pa.array(weight),
                        *(
                            pa.ListArray.from_arrays(np.arange(n + 1, dtype="i4") * width, pa.array(c.reshape(-1).view(np.int64)))
                            for c, width in ((bits, SKETCH_LONGS), (keys, BANDS))
                        ),
                    ],
                    names=["doc_id", "digest", "weight", "bits", "bands"],
                )

    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    return docs.select("doc_id", digest, "text").mapInArrow(sketch, "doc_id long, digest binary, weight long, bits array<long>, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (a, b, more numbers) that are linked, of the nodes in ``texts`` (node, text)."""
    more, less = SIMILARITY[1], SIMILARITY[0]
    names = pairs.columns

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # long texts in a batch are compared a few at a time
            sizes = np.add(*(np.asarray(pc.binary_length(batch.column(c)).cast(pa.int64())) for c in ("a_text", "b_text")))
            part_of = np.cumsum(sizes) // (1 << 22)
            for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part_of)) + 1):
                some = batch.slice(part[0], len(part)) if len(part) else batch
                shared, union = overlaps(some.column("a_text"), some.column("b_text"))
                keep = pa.array((shared * more >= union * less) & (union > 0))
                yield pa.RecordBatch.from_arrays([some.column(c).filter(keep) for c in names], names=names)

    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"{c}_text"))
    return (
        pairs.join(side("b"), "b", "inner")
        .join(side("a"), "a", "inner")
        .select(*names, "a_text", "b_text")
        .mapInArrow(linked, ", ".join(f"{c} long" for c in names))
    )


def _first() -> Column:
    """Orders rows by id, missing ones last, then by row."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def _nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and the distinct texts as nodes (node, digest, first, weight, bits, bands)."""
    sketches = stage(_sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    nodes = stage(
        sketches.groupBy("digest")
        .agg(F.min(_first()).alias("first"), *(F.first(c).alias(c) for c in ("weight", "bits", "bands")))
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct_texts",
    )
    return sketches, nodes


def _texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the ``wanted`` nodes, one row each.

    Only the first document of a text is read, so copies do not meet in one task.
    """
    key = lambda c: F.coalesce(F.col(c), F.lit(-(1 << 63))).alias("key")
    which = nodes.join(wanted, "node", "left_semi").select("node", "digest", key("first.doc_id"))
    return (
        docs.select(F.unhex(F.sha2("text", 256)).alias("digest"), key("doc_id"), "text")
        .join(which, ["digest", "key"], "inner")
        .groupBy("node")
        .agg(F.first("text").alias("text"))
    )


def _may_be_similar() -> Column:
    """Texts whose weights differ more cannot be similar enough, nor can, but for chance, those with more flips."""
    flips = sum(
        F.bit_count(F.col("a_bits").getItem(i).bitwiseXOR(F.col("b_bits").getItem(i))) for i in range(SKETCH_LONGS)
    )
    weights = F.least("a_weight", "b_weight") * SIMILARITY[1] >= F.greatest("a_weight", "b_weight") * SIMILARITY[0]
    return weights & (flips <= MOST_FLIPS)


def _leaders(buckets: DataFrame, turn: int) -> DataFrame:
    """(key, leader) of the buckets with several classes: a text of the largest class, another one each turn."""
    one = F.struct("node", "weight", "bits", "class")
    if not turn:  # each text is a class, and no bucket has a single one
        return buckets.groupBy("key").agg(F.min_by(one, "node").alias("leader"))
    order = F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"))
    of_classes = buckets.groupBy("key", "class").agg(F.count(F.lit(1)).alias("n"), F.min_by(one, order).alias("leader"))
    return (
        of_classes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("classes"), F.max_by("leader", F.struct("n", -F.col("class"))).alias("leader"))
        .filter("classes > 1")
        .select("key", "leader")
    )


def _with_leaders(buckets: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b, a_class, b_class) of each bucket's leader and the texts of other classes that may be similar."""
    lower = F.col("node") < F.col("leader.node")
    return (
        buckets.join(_leaders(buckets, turn), "key", "inner")
        .filter(F.col("class") != F.col("leader.class"))
        .select(
            F.least("node", "leader.node").alias("a"),
            F.greatest("node", "leader.node").alias("b"),
            F.when(lower, F.col("class")).otherwise(F.col("leader.class")).alias("a_class"),
            F.when(lower, F.col("leader.class")).otherwise(F.col("class")).alias("b_class"),
            F.col("weight").alias("a_weight"),
            F.col("leader.weight").alias("b_weight"),
            F.col("bits").alias("a_bits"),
            F.col("leader.bits").alias("b_bits"),
        )
        .filter(_may_be_similar())
        .select("a", "b", "a_class", "b_class")
        .distinct()
    )


def _units(texts: DataFrame) -> DataFrame:
    """(node, weight, units) of (node, text): each shingle as often as it occurs, told apart by number."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part_texts in chunks(batch.column("text")):
                n = len(part_texts.offsets) - 1
                owner, x, count = shingles(part_texts)
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                units = mix(np.repeat(x, count) ^ mix(nth.astype(np.uint64), 13), 14)
                weight = np.bincount(owner, weights=count, minlength=n).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(weight)]).astype("i4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(part_texts.first, n), pa.array(weight), pa.ListArray.from_arrays(ends, pa.array(units.view(np.int64)))],
                    names=["node", "weight", "units"],
                )

    return texts.mapInArrow(made, "node long, weight long, units array<long>")


def _prefixes(units: DataFrame) -> DataFrame:
    """(node, weight, unit, place): the units by which a text can meet others that are similar enough.

    Units are ordered by the number of texts they are in, rarest first. Two texts that share enough
    share a unit among the first ``weight - least overlap + 1`` of each. Units of a single
    text come first and meet nothing, so a text with that many of its own has no others.
    """
    each = units.select("node", "weight", F.explode("units").alias("unit"))
    known = each.groupBy("unit").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    more, less = SIMILARITY[1], SIMILARITY[0]
    own = F.col("weight") - F.size("shared")
    length = F.col("weight") - F.ceil(F.col("weight") * less / more).cast("long") + 1
    ordered = each.join(known, "unit", "inner").groupBy("node", "weight").agg(F.array_sort(F.collect_list(F.struct("texts", "unit"))).alias("shared"))
    return (
        ordered.withColumn("own", own)
        .filter(length > F.col("own"))
        .select("node", "weight", "own", F.posexplode(F.expr("slice(shared, 1, int(least(size(shared), {})))".format(f"weight - ceil(weight * {less} / {more}) + 1 - own"))).alias("at", "one"))
        .select("node", "weight", F.col("one.unit").alias("unit"), (F.col("own") + F.col("at")).alias("place"))
    )


def _apart(prefixes: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts of different classes that may be similar enough, of (node, class, weight, unit, place).

    Pairs within the largest class of a unit are never formed: texts outside it meet all. Units
    before a shared one at its places are in one text only, which bounds what the texts can share.
    """
    sizes = prefixes.groupBy("unit", "class").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("unit").agg(F.max(F.struct("n", "class")).alias("of"), F.count(F.lit(1)).alias("classes"))
    named = prefixes.join(largest.filter("classes > 1").select("unit", F.col("of.class").alias("largest")), "unit", "inner")
    side = lambda rows, c: rows.select("unit", *(F.col(x).alias(f"{c}_{x}") for x in ("node", "class", "weight", "place")), (F.col("class") == F.col("largest")).alias(f"{c}_in_largest"))
    most = F.least(F.col("a_weight") - F.col("a_place"), F.col("b_weight") - F.col("b_place"))
    more, less = SIMILARITY[1], SIMILARITY[0]
    enough = most * (more + less) >= (F.col("a_weight") + F.col("b_weight")) * less
    once = F.col("b_in_largest") | (F.col("a_node") < F.col("b_node"))
    pairs = side(named.filter("class <> largest"), "a").join(side(named, "b"), "unit", "inner").filter((F.col("a_class") != F.col("b_class")) & once & enough)
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _classes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have links."""
    keys = nodes.filter("weight > 0").select(F.explode("bands").alias("key"), "node", "weight", "bits")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    buckets = stage(keys.join(shared, "key", "left_semi"), "buckets")
    texts = stage(_texts_of(docs, nodes, buckets.select("node").distinct()), "bucket_texts")
    named = buckets.withColumn("class", F.col("node"))
    links, tried = None, None
    for turn in range(LEADER_TURNS):
        pairs = _with_leaders(named, turn)
        pairs = stage(pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs, "leader_pairs")
        found = stage(_verified(pairs, texts), "links")
        ends = lambda rows: rows.select("a", "b")
        tried = ends(pairs) if tried is None else tried.unionByName(ends(pairs))
        links = ends(found) if links is None else links.unionByName(ends(found))
        # only what this turn has linked is new: classes join classes
        joined = components(found.select(F.col("a_class").alias("a"), F.col("b_class").alias("b"))).withColumnRenamed("node", "class")
        named = stage(
            named.join(joined, "class", "left").select("key", "node", "weight", "bits", F.coalesce("component", "class").alias("class")),
            "named_buckets",
        )
    # what is left are texts that may be linked across classes; those that share a rare enough unit are compared
    of_more = named.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most")).filter("least < most").select("key")
    open_texts = stage(named.join(of_more, "key", "left_semi").select("node", "class").distinct(), "open_texts")
    prefixes = stage(_prefixes(stage(_units(texts.join(open_texts, "node", "left_semi")), "units")).join(open_texts, "node", "inner"), "prefixes")
    rest = stage(_apart(prefixes).join(tried, ["a", "b"], "left_anti"), "pairs")
    more = stage(_verified(rest, texts), "more_links")
    unstage(buckets, texts, named, prefixes, rest)
    return components(links.unionByName(more))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), class_size, kept, text_sha256."""
    docs = ids_and_texts(docs, id_col, text_col)
    sketches, nodes = _nodes(docs)
    classes = _classes(docs, nodes)
    of_node = stage(
        nodes.join(classes, "node", "left").select("digest", "first", F.coalesce("component", "node").alias("class")), "node_classes"
    )
    rows = sketches.select("doc_id", "row", "digest").join(of_node.select("digest", "class"), "digest", "inner")
    # written, so that the join below can split a class with many rows
    named = stage(rows.groupBy("class").agg(F.min(_first()).alias("first"), F.count(F.lit(1)).alias("class_size")), "class_names")
    return rows.join(named, "class", "inner").select(
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    key, digest = fresh("near_key", docs.columns), fresh("near_digest", docs.columns)
    missing = F.lit(-(1 << 63))
    verdict = stage(near_copies(docs, id_col, text_col), "near_copies").select(
        F.coalesce("doc_id", missing).alias(key), F.col("text_sha256").alias(digest), "kept"
    )
    marked = docs.withColumn(key, F.coalesce(quoted(id_col).cast("long"), missing)).withColumn(digest, F.sha2(whole_text(text_col), 256))
    # rows with the same id and text are told apart only if there are any that stay
    repeated = verdict.groupBy(key, digest).agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    out = marked.join(repeated.filter("NOT kept"), [key, digest], "left_anti")
    if not repeated.filter("kept AND n > 1").isEmpty():
        out = out.dropDuplicates([key, digest])
    return out.select(*columns_of(docs))
