"""Choosing rows: one per key, or the best ones with their ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the smallest by ``order``, then by all other columns, missing values last.

    A plain aggregate, so map tasks reduce each key before anything is shuffled.
    """
    columns = list(columns) if columns else [c for c in df.columns if c not in keys and c not in order]
    ranked = [*order, *(c for c in columns if c not in order)]
    # a flag before each column, because a struct puts missing values first
    parts = [part for c in ranked for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*parts)).alias("_row"))
        .select(*keys, *(F.col(f"_row.{c}").alias(c) for c in columns))
    )


def rows_at(df: DataFrame, keys: Sequence[str], best: Column, by: str) -> DataFrame:
    """All rows whose ``by`` equals the aggregate ``best`` of their key, ties kept.

    The aggregate is one small row per key; the rows themselves then only meet it in
    a semi join, which runtime re-planning broadcasts or splits on hot keys. No key
    ever has to fit into one task.
    """
    target = df.groupBy(*keys).agg(best.alias(by))
    return df.join(target, [*keys, by], "left_semi")


def latest_rows(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    return rows_at(df, keys, F.max(by), by)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of the whole table; every task keeps only its own ``n``."""
    return df.orderBy(*order).limit(n)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of every key. Tasks drop rows past rank ``n`` before the shuffle."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= n)
