"""Near copies among embeddings by an inverted multi-index.

Unit vectors are cut into halves and each half has a codebook of its own; the product of the
two codebooks is a grid of cells, kept apart by label. A query visits cells in the order of
how far they are from it, the sum of its least squared distances to the two halves of a cell,
as the multi-sequence algorithm lists them, and stops at the distance within which the target
share of links lies. That distance is measured on the sample: on its real links and on pairs
made to lie exactly at the similarity sought. Every vector is both indexed and a query, and
visited vectors are compared exactly, in double precision.

Only vectors with equal labels meet. Vectors without a label, without components, of zero
length or with missing or non-finite components link with nothing. Equal vectors are indexed
once and counted by their number. Crowded cells are split into blocks, so no task holds more
than two blocks. A missing id names a component only if nothing else does. An empty table
gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.session import stage

SIMILARITY = 0.93
TARGET_RECALL = 0.9999
# codebooks and the distance to stop at are fitted on at most so many distinct vectors
SAMPLE = 16_384
PAIRS_FROM = 2048
PER_CELL = 64
BLOCK = 1024
ROUNDS = 8


class Index(NamedTuple):
    left: np.ndarray  # centres of the first halves
    right: np.ndarray
    reach: float  # squared distance at which a query stops

    def halves(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        cut = self.left.shape[1]
        return [_nearest(vectors[:, :cut], self.left), _nearest(vectors[:, cut:], self.right)]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        (a, _), (b, _) = self.halves(vectors)
        return a * len(self.right) + b

    def visits(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and cell of each visit: with both lists sorted, the cells below a staircase."""
        (_, first), (_, second) = self.halves(vectors)
        order = np.argsort(second, axis=1)
        second = np.take_along_axis(second, order, axis=1)
        room = self.reach - first
        # how far each query goes in its second list, for each centre of the first
        steps = (second[:, None, :] <= room[:, :, None]).sum(axis=2)
        query, a = np.nonzero(steps)
        counts = steps[query, a]
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        query, a = np.repeat(query, counts), np.repeat(a, counts)
        return query, a * len(self.right) + order[query, place]

    def distances(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of each vector (row) to each of the cells (column)."""
        (_, first), (_, second) = self.halves(vectors)
        return first[:, cells // len(self.right)] + second[:, cells % len(self.right)]

    def distance(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Of each vector to the one cell of its place."""
        (_, first), (_, second) = self.halves(vectors)
        rows = np.arange(len(vectors))
        return first[rows, cells // len(self.right)] + second[rows, cells % len(self.right)]


def _nearest(halves: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each half, and its squared distance to the region of every centre.

    What is nearer to centre j than to the nearest centre i lies beyond the plane between them.
    """
    squares = (centres**2).sum(axis=1)[None, :] - 2 * halves @ centres.T
    nearest = squares.argmin(axis=1)
    apart = np.sqrt(np.maximum(((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2), 1e-300))[nearest]
    beyond = np.maximum(squares - squares[np.arange(len(halves)), nearest][:, None], 0.0) / (2 * apart)
    beyond[np.arange(len(halves)), nearest] = 0.0
    return nearest, beyond**2


def _centres(halves: np.ndarray, count: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(halves, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:count]]
    for _ in range(ROUNDS):
        nearest = ((centres**2).sum(axis=1)[None, :] - 2 * halves @ centres.T).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, halves)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def fit(sample: np.ndarray, labels: np.ndarray, count: int, similarity: float, recall: float) -> Index:
    """Codebooks of ``count`` centres for each half, and where to stop for ``recall``."""
    cut = sample.shape[1] // 2
    index = Index(_centres(sample[:, :cut], count, 1), _centres(sample[:, cut:], count, 2), 0.0)
    rng = np.random.default_rng(3)
    base = sample[rng.integers(0, len(sample), 4 * PAIRS_FROM)]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1)[:, None] * base
    away /= np.maximum(np.linalg.norm(away, axis=1), 1e-12)[:, None]
    moved = similarity * base + np.sqrt(1 - similarity**2) * away
    reach = np.quantile(index.distance(moved, index.cells(base)), recall)
    some, of = sample[:PAIRS_FROM], labels[:PAIRS_FROM]
    a, b = np.nonzero((some @ some.T >= similarity) & (of[:, None] == of[None, :]))
    if len(a):
        apart = index.distances(some, index.cells(some))
        reach = max(reach, np.quantile(apart[a, b], recall))
    return index._replace(reach=float(reach))


def _unit(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, digest, unit) of (vec_id, embedding, label); only usable vectors have a digest."""

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, units = [], []
            for label, raw in zip(batch.column("label").to_pylist(), batch.column("embedding")):
                values = raw.values if raw.is_valid else None
                unit = None
                if label is not None and values is not None and len(values) and not values.null_count:
                    v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                    largest = np.abs(v).max()
                    if np.isfinite(largest) and largest > 0:
                        v = v / largest
                        unit = (v / np.sqrt(v @ v)).astype("<f8").tobytes()
                units.append(unit)
                digests.append(None if unit is None else hashlib.blake2b(b"%d:" % label + unit, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
                names=["vec_id", "label", "digest", "unit"],
            )

    return vectors.mapInArrow(normalise, "vec_id long, label long, digest binary, unit binary")


def _matrix(column) -> np.ndarray:
    joined = b"".join(column)
    return np.frombuffer(joined, dtype="<f8").reshape(len(column), -1)


def _placed(nodes: DataFrame, index: Index) -> DataFrame:
    """Entries (probe false) of each node's own cell and probes (true) of the cells it visits."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                vectors = _matrix(part.column("unit").to_pylist())
                query, visited = index.visits(vectors)
                rows = pa.array(np.concatenate([np.arange(len(vectors)), query]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(rows) for c in ("node", "label", "dimensions", "size")),
                        pa.array(np.concatenate([index.cells(vectors), visited])),
                        pa.array(np.arange(len(rows)) >= len(vectors)),
                    ],
                    names=["node", "label", "dimensions", "size", "cell", "probe"],
                )

    return nodes.select("node", "label", "dimensions", "size", "unit").mapInArrow(
        place, "node long, label long, dimensions int, size long, cell long, probe boolean"
    )


def _links_in(index: Index, similarity: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        """Links between the probes and the entries of a block, as degrees and a spanning forest."""
        probes, entries = group[group.probe], group[~group.probe]
        out = pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64")})
        if probes.empty or entries.empty:
            return out
        p, e = _matrix(probes.unit.tolist()), _matrix(entries.unit.tolist())
        pn, en = probes.node.to_numpy(), entries.node.to_numpy()
        linked = (p @ e.T >= similarity) & (pn[:, None] != en[None, :])
        a, b = np.nonzero(linked)
        if not len(a):
            return out
        links = np.zeros(len(pn), dtype=np.int64)
        np.add.at(links, a, entries["size"].to_numpy()[b])
        # where the entry does not visit the probe's cell in turn, this is its only meeting
        alone = index.distances(e, index.cells(p))[b, a] > index.reach
        back = np.zeros(len(en), dtype=np.int64)
        np.add.at(back, b[alone], probes["size"].to_numpy()[a[alone]])
        # least node of each part connected within the block
        of_probe, of_entry = pn.copy(), en.copy()
        while True:
            before = of_probe.copy(), of_entry.copy()
            least = np.minimum(of_probe[a], of_entry[b])
            np.minimum.at(of_probe, a, least)
            np.minimum.at(of_entry, b, least)
            if (before[0] == of_probe).all() and (before[1] == of_entry).all():
                break
        return pd.DataFrame(
            {"node": np.concatenate([pn, en]), "links": np.concatenate([links, back]), "other": np.concatenate([of_probe, of_entry])}
        ).query("links > 0 or node != other")

    return compare


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
    recall: float = TARGET_RECALL,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (least id reachable), kept."""
    rows = stage(
        _unit(
            vectors.select(
                F.col(id_col).cast("long").alias("vec_id"),
                F.col(vector_col).alias("embedding"),
                F.col(label_col).cast("long").alias("label"),
            )
        ),
        "unit_vectors",
    )
    nodes = stage(
        rows.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size"), F.first("label").alias("label"), F.first("unit").alias("unit")
        )
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("dimensions", F.length("unit")),
        "distinct_vectors",
    )
    found = None
    # vectors of different dimensions do not meet; there is a handful of them at most
    for (dimensions,) in nodes.select("dimensions").distinct().collect():
        own = nodes.filter(F.col("dimensions") == dimensions)
        # a bounded sample, by hashed digest
        chosen = own.orderBy(F.xxhash64("digest"), "digest").limit(sample).select("label", "unit").toPandas()
        crowd = own.groupBy("label").count().agg(F.max("count")).first()[0]
        centres = int(np.clip(np.ceil(np.sqrt(crowd / PER_CELL)), 4, 256))
        index = fit(_matrix(chosen.unit.tolist()), chosen.label.to_numpy(), centres, similarity, recall)
        some = stage(_block_links(own, index, similarity), "vector_links")
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, links long, other long")
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    of_node = stage(
        nodes.join(degrees, "node", "left")
        .join(classes, "node", "left")
        .select("digest", "first", "size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("class")),
        "vector_classes",
    )
    named = of_node.groupBy("class").agg(F.min("first").alias("component_id"))
    usable = of_node.join(named, "class", "inner").select(
        "digest", (F.col("size") - 1 + F.col("links")).alias("n_links"), "component_id"
    )
    with_links = rows.filter("digest IS NOT NULL").join(usable, "digest", "inner").select("vec_id", "n_links", "component_id")
    without = rows.filter("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return with_links.unionByName(without).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _block_links(nodes: DataFrame, index: Index, similarity: float) -> DataFrame:
    """(node, links, other): degrees by block, and a link to the least node connected there.

    The entries of a cell are dealt into blocks, and so are its probes; every block of entries
    meets every block of probes. Only then do vectors travel.
    """
    cell = ["label", "cell"]
    placed = stage(_placed(nodes, index), "placed_vectors")
    blocks = placed.groupBy(*cell).agg(
        F.ceil(F.count_if(~F.col("probe")) / BLOCK).alias("entry_blocks"), F.ceil(F.count_if("probe") / BLOCK).alias("probe_blocks")
    ).filter("entry_blocks > 0")
    own = F.when(F.col("probe"), F.col("probe_blocks")).otherwise(F.col("entry_blocks"))
    other = F.when(F.col("probe"), F.col("entry_blocks")).otherwise(F.col("probe_blocks"))
    dealt = (
        placed.join(blocks, cell, "inner")
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), own))
        .filter("probe_blocks > 0")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), other - 1)))
        .select(
            *cell,
            F.when(F.col("probe"), F.col("other")).otherwise(F.col("own")).alias("entry_block"),
            F.when(F.col("probe"), F.col("own")).otherwise(F.col("other")).alias("probe_block"),
            "node",
            "size",
            "probe",
        )
        .join(nodes.select("node", "unit"), "node", "inner")
    )
    return dealt.groupBy(*cell, "entry_block", "probe_block").applyInPandas(
        _links_in(index, similarity), "node long, links long, other long"
    )
