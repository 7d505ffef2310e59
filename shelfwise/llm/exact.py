"""Exact copies of documents, with frequent texts handled apart.

A Misra-Gries summary of every partition names the digests that may be frequent; the few
that truly are get counted exactly and broadcast, so all but one of their rows are decided
on the map side. Only digests without a hot group go through a shuffle.

Texts are equal when identical; a missing text is empty. Of equal texts the row with the
largest id stays; a missing id is smaller than any other. Of rows that repeat both the id
and the text, one stays. An empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tables import columns_of, fresh, quoted, whole_text
from shelfwise.session import stage

COUNTERS = 1024


def summaries(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Misra-Gries summary of each partition: at most ``counters`` rows (digest, at_least).

    A digest with n rows in the partition is counted at least n - rows / (counters + 1) times.
    """

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.Series(dtype="int64")
        for frame in frames:
            held = held.add(frame[column].value_counts(), fill_value=0).astype("int64")
            if len(held) > counters:
                # the next largest count is taken off every counter; what reaches zero goes
                held = held - held.nlargest(counters + 1).iloc[-1]
                held = held[held > 0]
        yield pd.DataFrame({column: held.index.to_series().astype(object).to_numpy(), "at_least": held.to_numpy()})

    return digests.select(column).mapInPandas(summarise, f"{column} string, at_least long")


def heavy_candidates(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters + 1`` digests, among them all with over 2 / (counters + 1) of the rows.

    The counts of all summaries add up to no more than the rows, so that many can reach
    1 / (counters + 1) of them; a summary misses no more than that of any digest.
    """
    rows = digests.count()
    return (
        summaries(digests, column, counters)
        .groupBy(column)
        .agg(F.sum("at_least").alias("at_least"))
        .filter(F.col("at_least") * (counters + 1) >= F.lit(rows))
        .select(column)
    )


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stage(
        docs.select(
            quoted(id_col).cast("long").alias("doc_id"),
            F.sha2(whole_text(text_col), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    best = F.struct("doc_id", "row")
    # as few rows as there are counters, whatever the size of the corpus
    heavy = stage(
        rows.join(F.broadcast(heavy_candidates(rows, "text_sha256", counters)), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(best).alias("best")),
        "heavy_digests",
    )
    of_heavy = rows.join(F.broadcast(heavy), "text_sha256", "inner")
    same = Window.partitionBy("text_sha256")
    rest = (
        rows.join(F.broadcast(heavy), "text_sha256", "left_anti")
        .withColumn("group_size", F.count(F.lit(1)).over(same))
        .withColumn("best", F.max(best).over(same))
    )
    return of_heavy.unionByName(rest).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A text crosses the network once, and only if its digest is not among the frequent ones.
    """
    digest, keep, place = (fresh(n, docs.columns) for n in ("digest", "keep_id", "place"))
    marked = docs.withColumn(digest, F.sha2(whole_text(text_col), 256))
    rows = stage(marked.select(quoted(id_col).alias(keep), digest), "digests")
    heavy = stage(
        rows.join(F.broadcast(heavy_candidates(rows, digest, counters)), digest, "left_semi")
        .groupBy(digest)
        .agg(F.max(keep).alias(keep)),
        "heavy_digests",
    )
    winners = (
        marked.join(F.broadcast(heavy), digest, "inner")
        .filter(quoted(id_col).eqNullSafe(F.col(keep)))
        .dropDuplicates([digest])
    )
    newest = Window.partitionBy(digest).orderBy(quoted(id_col).desc_nulls_last())
    rest = (
        marked.join(F.broadcast(heavy), digest, "left_anti")
        .withColumn(place, F.row_number().over(newest))
        .filter(F.col(place) == 1)
    )
    return winners.select(*columns_of(docs)).unionByName(rest.select(*columns_of(docs)))
