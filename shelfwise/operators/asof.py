"""As-of joins for many days at once, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import stage


def latest_days(wanted: DataFrame, known: DataFrame, keys: Sequence[str], day: str, known_day: str) -> DataFrame:
    """``wanted`` (keys, day, ...) with ``known_day``: the latest day of ``known`` up to ``day``, or null.

    Both tables are merged in the order of keys and days, and the last known day is carried
    forward, so no day meets more than one known row. The merged rows are range partitioned, which
    cuts a large key into slices; days are carried on inside a slice, and between slices by one row
    per key and slice. The slices are written once, because both uses need the same ones.
    Missing keys are a key like others; a missing day has no known day.
    """
    extra = [c for c in wanted.columns if c not in (*keys, day)]
    stock = known.filter(F.col(known_day).isNotNull()).select(*keys, F.col(known_day).alias("_day")).distinct()
    merged = (
        wanted.select(*keys, F.col(day).alias("_day"), *extra)
        .withColumn("_wanted", F.lit(1))
        .unionByName(stock.withColumn("_wanted", F.lit(0)), allowMissingColumns=True)
        .withColumn("_known", F.when(F.col("_wanted") == 0, F.col("_day")))
    )
    order = [*(F.col(k) for k in keys), F.col("_day"), F.col("_wanted")]
    # one key for key and slice: structs compare missing values as equal, and the window
    # and the join below share one shuffle by it
    slices = stage(
        merged.repartitionByRange(*order).withColumn(
            "_at", F.struct(F.struct(*keys).alias("key"), F.spark_partition_id().alias("slice"))
        ),
        "asof_slices",
    )
    earlier = Window.partitionBy("_at.key").orderBy("_at.slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slices.groupBy("_at").agg(F.max("_known").alias("_last")).select("_at", F.max("_last").over(earlier).alias("_carried"))
    )
    so_far = Window.partitionBy("_at").orderBy("_day", "_wanted").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # days ascend, so the last one so far is the greatest
    return (
        slices.withColumn("_last", F.max("_known").over(so_far))
        .filter("_wanted = 1")
        .join(carried, "_at", "inner")
        .select(
            *keys,
            F.col("_day").alias(day),
            *extra,
            F.when(F.col("_day").isNotNull(), F.coalesce("_last", "_carried")).alias(known_day),
        )
    )


def asof_rows(wanted: DataFrame, known: DataFrame, keys: Sequence[str], day: str, known_day: str) -> DataFrame:
    """Rows of ``wanted`` with the rows of ``known`` of the latest day up to theirs, ties kept.

    Rows without any known day are left out.
    """
    found = latest_days(wanted, known, keys, day, known_day).filter(F.col(known_day).isNotNull())
    return found.join(known, [*keys, known_day], "inner")
