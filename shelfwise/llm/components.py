"""Connected components of an undirected graph held as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import stage, unstage

# so many links at most, whatever the size of the graph, are finished where they are read, without further rounds
FEW_LINKS = 10_000


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def least_nodes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a few links, and the least node that each is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    least = np.arange(len(nodes))
    while (least[a] != least[b]).any():
        lower, upper = np.minimum(least[a], least[b]), np.maximum(least[a], least[b])
        np.minimum.at(least, upper, lower)
        while (least[least] != least).any():
            least = least[least]
    return nodes, nodes[least]


def _finished(links: DataFrame) -> DataFrame:
    """(node, parent) of a few links, the parent being the least node of the component."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(np.asarray(batch.column("a")), np.asarray(batch.column("b"))) for batch in batches]
        if parts:
            found = least_nodes(*(np.concatenate(side) for side in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in found], names=["node", "parent"])

    return links.coalesce(1).mapInArrow(finish, "node long, parent long")


def components(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by its least node.

    Each round, every node joins its least neighbour, and the links are carried over to what
    is left. By number, stars around a least node go in one round; every second round the order
    is shuffled anew, which takes a share of any other shape, chains in order too. The rounds
    are written tables, and a final pass follows each node through them. Once ``few`` links or
    less are left, which rounds would shorten by halves only, one task finishes them. Loops and
    repeated links do not matter. No neighbourhood is ever gathered: hubs are a minimum and a
    skewed join.
    """
    rest = stage(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    rounds: list[DataFrame] = []
    by_number = True
    while left := rest.count():
        if left <= few:
            rounds.append(stage(_finished(rest), "joined"))
            break
        turn = len(rounds)
        by_number = by_number and turn % 2 == 0
        order = lambda c: F.xxhash64(F.col(c), F.lit(turn)) if turn % 2 else F.col(c)
        place = lambda c: F.struct(order(c).alias("place"), F.col(c).alias("node"))
        joined = stage(
            _both_ways(rest)
            .groupBy("a")
            .agg(F.min(place("b")).alias("least"))
            .select(F.col("a").alias("node"), F.least(F.col("least"), place("a")).getField("node").alias("parent")),
            "joined",
        )
        rounds.append(joined)
        to = lambda c: joined.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_parent"))
        following = stage(
            rest.join(to("a"), "a", "inner")
            .join(to("b"), "b", "inner")
            .filter("a_parent <> b_parent")
            .select(F.least("a_parent", "b_parent").alias("a"), F.greatest("a_parent", "b_parent").alias("b"))
            .distinct(),
            "links",
        )
        unstage(rest)
        rest = following
    unstage(rest)
    if not rounds:
        return links.sparkSession.createDataFrame([], "node long, component long")
    roots = rounds[-1].withColumnRenamed("parent", "root")
    for joined in reversed(rounds[:-1]):
        roots = stage(
            joined.join(roots.withColumnRenamed("node", "parent"), "parent", "left").select(
                "node", F.coalesce("root", "parent").alias("root")
            ),
            "roots",
        )
    if by_number:  # the least node of a component is never joined to another
        return roots.withColumnRenamed("root", "component")
    names = roots.groupBy("root").agg(F.min("node").alias("component"))
    return stage(roots.join(names, "root", "inner").select("node", "component"), "components")
