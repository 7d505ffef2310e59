"""Near vectors against all pairs, and the index against its promises."""

import numpy as np
import pytest

from shelfwise.llm.embeddings import fit, near_vectors
from shelfwise.llm.queries import op3_embedding_near_dedup

COLUMNS = "vec_id long, embedding array<float>, label int, cell int"


def by_all_pairs(rows, similarity=0.93):
    ok = [
        label is not None and v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
        for _, v, label in rows
    ]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if k else None for (_, v, _), k in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= similarity:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    least = {}
    for i in range(len(rows)):
        r = find(i)
        least[r] = min(least.get(r, i), i, key=key)
    return sorted(((rows[i][0], links[i], rows[least[find(i)]][0]) for i in range(len(rows))), key=str)


def cloud(n=400, hot=0):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        v = rng.normal(size=16) if i % 4 else rows[rng.integers(0, i)][1] + rng.normal(size=16) * rng.choice([0, 0.05, 0.3]) if i else rng.normal(size=16)
        rows.append((i, np.asarray(v), int(rng.integers(0, 3))))
    base = rng.normal(size=16)
    rows += [(n + k, base + rng.normal(size=16) * 0.1 * (k % 5), 1) for k in range(hot)]
    return [(i, np.float32(v).tolist(), label) for i, v, label in rows]


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("hot", [0, 2500])
def test_all_links(spark, table, hot):
    rows = cloud(hot=hot)
    out = near_vectors(table(COLUMNS, *((*r, 9) for r in rows)).repartition(3))
    if hot:
        assert len(got(out)) == len(rows)
        links = {r.vec_id: r.n_links for r in out.collect()}
        unit = np.array([v for _, v, _ in rows[400:]], dtype=float)
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
        assert (np.array([links[400 + k] for k in range(hot)]) - want).min() >= 0
        assert sum(links[400 + k] for k in range(hot)) - want.sum() <= 2 * hot
    else:
        assert got(out) == by_all_pairs(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in out.collect())


def test_unusable_vectors(spark, table):
    rows = [
        (1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, [1.0, 2.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
        (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [], 1), (None, [1.0, 2.0], 1), (2, [2.0, 4.0], 1),
        (11, [1.0, 2.0, 0.0], 1), (12, [1.0, 2.0, 0.1], 1), (13, [1.0, 2.0], 2),
    ]
    assert got(near_vectors(table(COLUMNS, *((*r, 0) for r in rows)))) == by_all_pairs(rows)
    assert near_vectors(table(COLUMNS)).collect() == []
    assert got(near_vectors(table(COLUMNS, (1, None, None, 0)))) == [(1, 0, 1)]


def test_visits_reach_the_target(spark):
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(3000, 32))
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    index = fit(sample, np.zeros(3000, dtype=int), 8, 0.93, 0.999)
    away = rng.normal(size=sample.shape)
    away -= (away * sample).sum(axis=1)[:, None] * sample
    away /= np.linalg.norm(away, axis=1)[:, None]
    other = 0.93 * sample + np.sqrt(1 - 0.93**2) * away
    query, cell = index.visits(sample)
    visited = set(zip(query.tolist(), cell.tolist()))
    reached = np.mean([(i, c) in visited for i, c in enumerate(index.cells(other).tolist())])
    assert reached > 0.99 and len(visited) < 0.7 * 3000 * len(index.left) * len(index.right)


def test_query_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert got(op3_embedding_near_dedup(spark, sf_dir)) == by_all_pairs(rows)


def test_recall_of_planted_links_at_the_border(spark, table):
    """Vectors of the table with a neighbour each just above, and one just below, the similarity sought."""
    sf_dir = "/root/testdata/sf0.01"
    held = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rng = np.random.default_rng(6)
    rows = list(held)
    for i, v, label in held:
        v = np.array(v, dtype=np.float64)
        v /= np.linalg.norm(v)
        for k, cosine in ((1, rng.uniform(0.9301, 0.935)), (2, rng.uniform(0.925, 0.9299))):
            away = rng.normal(size=len(v))
            away -= (away @ v) * v
            other = cosine * v + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away)
            rows.append((i + k * 1_000_000, np.float32(other * rng.uniform(0.5, 2)).tolist(), label))
    links = {r.vec_id: r.n_links for r in near_vectors(table(COLUMNS, *((*r, 0) for r in rows)).repartition(5)).collect()}
    unit = np.array([v for _, v, _ in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    want = ((unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])).sum(axis=1) - 1
    got_links = np.array([links[r[0]] for r in rows])
    assert want.sum() >= 2 * len(held) and (got_links <= want).all()
    assert got_links.sum() >= 0.999 * want.sum()
