"""Centroid clustering in exact integers over dictionary-encoded vectors.

Vectors become integers and are cut into blocks of two dimensions. Chunks of vectors hold, for
each block, a dictionary of its distinct subvectors and one code per vector; nothing is lost. In
a round each dictionary entry gets its squared distance to each centroid once; a vector's distances
are sums of what its codes point to, and sums over clusters are counts of codes times entries. So a
round is one pass over the codes without a shuffle of vectors; what leaves a chunk is one row per
cluster, whatever the shares of the clusters.

Vectors that are missing, of another length, or with missing or non-finite components are left
out, and so are not in the result. Scaled components beyond ``LARGEST`` either way are held there,
so that a distance fits in a long; sums beyond the largest long are held at it. With fewer vectors
than clusters there are as many clusters as vectors; without any the result is empty. Repeated rows
and equal vectors count each; starts with the same hash (repeated ids, or missing ones, which
hash as empty) are ordered by their components. Columns that are not read do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import quoted
from shelfwise.session import stage, unstage

WIDTH = 2
# vectors to a dictionary; a code has 16 bits
CHUNK = 8192
LARGEST = 1 << 26
LONGEST = (1 << 63) - 1

_ENCODED = "ids array<long>, codes binary, sizes array<int>, entries binary"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, vector) of the vectors with ``dims`` finite components, as integers floor(scale * x)."""
    wide = quoted(vector_col).cast("array<double>")
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    held = lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x * scale, F.lit(2.0 * LARGEST)), F.lit(-2.0 * LARGEST))), F.lit(LARGEST)), F.lit(-LARGEST))
    return vectors.filter((F.size(wide) == dims) & F.forall(wide, finite)).select(
        quoted(id_col).cast("long").alias("id"), F.transform(wide, held).cast("array<int>").alias("vector")
    )


def encode(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``block`` and the code of each row."""
    key = np.zeros(len(block), dtype=np.int64)
    for column in range(block.shape[1]):
        key = (key << 32) + block[:, column]
    _, first, codes = np.unique(key, return_index=True, return_inverse=True)
    return block[first], codes.astype(np.uint16)


def dictionaries(rows: DataFrame, dims: int) -> DataFrame:
    """Chunks of (id, vector): ids, codes by block, and the sizes and entries of the dictionaries."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy().reshape(-1, dims)
            for at in range(0, len(values), CHUNK):
                part = values[at : at + CHUNK]
                found = [encode(part[:, d : d + WIDTH]) for d in range(0, dims, WIDTH)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0).slice(at, CHUNK).to_pylist()], pa.list_(pa.int64())),
                        pa.array([np.concatenate([c for _, c in found]).tobytes()], pa.binary()),
                        pa.array([[len(e) for e, _ in found]], pa.list_(pa.int32())),
                        pa.array([b"".join(e.tobytes() for e, _ in found)], pa.binary()),
                    ],
                    names=["ids", "codes", "sizes", "entries"],
                )

    return rows.mapInArrow(chunks, _ENCODED)


def _blocks(batch: pa.RecordBatch, row: int, dims: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Of one chunk, block by block: its dimensions, dictionary and codes."""
    sizes = batch.column("sizes")[row].as_py()
    codes = np.frombuffer(batch.column("codes")[row].as_py(), dtype=np.uint16).reshape(len(sizes), -1)
    entries = np.frombuffer(batch.column("entries")[row].as_py(), dtype=np.int32)
    at = 0
    for number, size in enumerate(sizes):
        block = slice(number * WIDTH, min((number + 1) * WIDTH, dims))
        width = block.stop - block.start
        yield block, entries[at : at + size * width].reshape(size, width).astype(np.int64), codes[number]
        at += size * width


def nearest(batch: pa.RecordBatch, row: int, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector of a chunk; of equally near centroids the first."""
    total = 0
    for block, entries, codes in _blocks(batch, row, centroids.shape[1]):
        apart = ((entries[:, None, :] - centroids[None, :, block]) ** 2).sum(axis=2)
        total = total + apart[codes]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(cluster)), cluster]


def cluster_sums(encoded: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Vectors and component sums of each non-empty cluster: one row per cluster and dimension."""
    count, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, dims + 1), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                cluster, _ = nearest(batch, row, centroids)
                total[:, dims] += np.bincount(cluster, minlength=count)
                for block, entries, codes in _blocks(batch, row, dims):
                    seen = np.bincount(cluster * len(entries) + codes, minlength=count * len(entries))
                    total[:, block] += seen.reshape(count, -1) @ entries
        met = np.flatnonzero(total[:, dims])
        yield pa.RecordBatch.from_arrays([pa.array(met.astype("i4")), pa.array(list(total[met]), pa.list_(pa.int64()))], names=["cluster", "sums"])

    rows = (
        encoded.mapInArrow(sums, "cluster int, sums array<long>")
        .select("cluster", F.posexplode("sums").alias("dim", "sum"))
        .groupBy("cluster", "dim")
        .agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
        .collect()
    )
    by_place = {(r["cluster"], r["dim"]): int(r["sum"]) for r in rows}
    return {c: (n, [by_place[c, d] for d in range(dims)]) for (c, d), n in by_place.items() if d == dims}


def first_centroids(rows: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id."""
    ticket = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    chosen = rows.select(ticket.alias("ticket"), "vector").orderBy("ticket", "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in chosen], dtype=np.int64)


def assigned(encoded: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cluster, distance = nearest(batch, row, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, pa.array(cluster.astype("i4")), pa.array(distance)], names=["id", "cluster", "distance"]
                )

    return encoded.mapInArrow(assign, "id long, cluster int, distance long")


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: str = "1:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per whole vector: its id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows = whole_vectors(vectors, id_col, vector_col, dims, scale)
    centroids = first_centroids(rows, clusters, seed)
    if not len(centroids):
        empty = rows.filter("false").select(F.col("id").alias(id_col))
        return empty.selectExpr("*", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    encoded = stage(dictionaries(rows, dims), "vector_codes")
    for _ in range(rounds):
        for cluster, (count, sums) in cluster_sums(encoded, centroids).items():
            centroids[cluster] = [total // count for total in sums]
    placed = stage(assigned(encoded, centroids), "placed_vectors")
    unstage(encoded)
    # one row per cluster
    totals = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    of_cluster = {r["cluster"]: int(r["inertia"]) for r in totals}
    held = lambda total: F.lit(min(total, LONGEST)).cast("long")
    digest = lambda centroid: hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
    at = F.col("cluster") + 1
    return placed.select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        F.element_at(F.array(*(held(of_cluster.get(c, 0)) for c in range(len(centroids)))), at).alias("cluster_inertia"),
        held(sum(of_cluster.values())).alias("inertia"),
        F.element_at(F.array(*(F.lit(digest(c)) for c in centroids)), at).alias("centroid_sha256"),
    )
