"""Integer clustering against plain numpy."""

import hashlib

import numpy as np
import pytest

from __spark_entry__ import oracle_sql, queries
from registry.check import compare, connect
from shelfwise.llm import centroids
from shelfwise.llm.centroids import LARGEST, cluster_vectors, encode

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, clusters, rounds, dims):
    whole = [(i, np.floor(64 * np.array(v, dtype=np.float64)).clip(-LARGEST, LARGEST).astype(np.int64)) for i, v in rows
             if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    if not whole:
        return []
    ticket = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1].tolist())
    middle = np.array([v for _, v in sorted(whole, key=ticket)[:clusters]])
    points = np.array([v for _, v in whole])
    for turn in range(rounds + 1):
        apart = ((points[:, None] - middle[None]) ** 2).sum(axis=2)
        near = apart.argmin(axis=1)
        for c in range(len(middle) if turn < rounds else 0):
            if (near == c).any():
                middle[c] = [sum(int(x) for x in column) // int((near == c).sum()) for column in points[near == c].T]
    distance = apart.min(axis=1)
    name = lambda c: hashlib.sha256(",".join(map(str, middle[c].tolist())).encode()).hexdigest()
    return sorted(
        ((i, int(c), int(d), int(distance[near == c].sum()), int(distance.sum()), name(c)) for (i, _), c, d in zip(whole, near, distance)), key=str
    )


def rows_of(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("dims,chunk", [(6, 7), (5, 8192), (1, 16)])
def test_clusters(spark, table, monkeypatch, dims, chunk):
    monkeypatch.setattr(centroids, "CHUNK", chunk)
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in rng.normal(size=dims).round(2)]) for i in range(300)]
    rows += [(500 + i, rows[0][1]) for i in range(100)]  # a hot vector
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(700, None), (701, []), (702, rows[0][1] + [0.0]), (703, [None] * dims), (704, [float("nan")] * dims), (705, [float("-inf")] * dims)]
    rows += [(800, [0.0] * dims), (801, [-0.001] * dims)]
    vectors = table("vec_id long, embedding array<double>, cluster string, id int, `a.b` int", *((*r, "x", 1, 2) for r in rows)).repartition(3)
    assert rows_of(cluster_vectors(vectors, 5, 3, dims)) == plain(rows, 5, 3, dims)


def test_fewer_vectors_than_clusters_and_none(spark, table):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    schema = "vec_id long, embedding array<float>"
    assert rows_of(cluster_vectors(table(schema, *rows), dims=2)) == plain(rows, 16, 3, 2)
    assert rows_of(cluster_vectors(table(schema, *rows), dims=3)) == rows_of(cluster_vectors(table(schema), dims=2)) == []


def test_huge_components_are_held(spark, table):
    rows = [(i, [sign * 1e300, 1e-300 * i]) for i, sign in enumerate([1, -1, 1, -1, 1])]
    got = rows_of(cluster_vectors(table("vec_id long, embedding array<double>", *rows), 2, 3, 2))
    assert got == plain(rows, 2, 3, 2) and all(0 <= r[2] <= 2**63 - 1 for r in got)


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(3)
    block = rng.integers(-3, 3, (500, 2)).astype(np.int32)
    block[:3] = [[LARGEST, -LARGEST], [-LARGEST, LARGEST], [-1, -1]]
    entries, codes = encode(block)
    assert (entries[codes] == block).all() and len(entries) == len({tuple(r) for r in block.tolist()})


def test_query(spark):
    df = queries()["op12_centroid_clustering"](spark, SF_DIR)
    assert compare(df, connect(SF_DIR), oracle_sql()["op12_centroid_clustering"]) is None
