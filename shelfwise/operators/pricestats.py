"""Price statistics from value counts.

Every statistic of a key is derived from the counts of its distinct prices. Counting
is a plain aggregate on (key, price), reduced map side and spread over all tasks even
when one key holds most rows. Windows only ever see the counted prices of a key, whose
number is bounded by the price grid and not by the number of observations. Percentiles
are exact and always are a price that was observed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.prices import ending_price

STORE_HISTORY_PERCENTILES = {"p10": 0.10, "p20": 0.20, "p80": 0.80, "p90": 0.90}
FORMAT_PERCENTILES = {"p05": 0.05, "p10": 0.10, "p90": 0.90, "p95": 0.95}


def price_counts(df: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    return (
        df.filter(F.col(price).isNotNull())
        .groupBy(*keys, F.col(price).alias("_price"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def price_stats(
    df: DataFrame,
    keys: Sequence[str],
    price: str,
    prefix: str,
    measures: Sequence[str] = ("avg", "std", "median"),
    percentiles: Mapping[str, float] | None = None,
) -> DataFrame:
    """``{prefix}_{measure}`` per key.

    Measures: avg, std, min, max, median, mode, mode_freq, count. The mode is taken over
    prices moved to their allowed ending, the lowest of equally frequent ones winning.
    """
    return stats_of_counts(price_counts(df, keys, price), keys, prefix, measures, percentiles)


def stats_of_counts(
    counts: DataFrame,
    keys: Sequence[str],
    prefix: str,
    measures: Sequence[str] = ("avg", "std", "median"),
    percentiles: Mapping[str, float] | None = None,
) -> DataFrame:
    """The same from ``price_counts``, or sums of several of them: one row per key and price."""
    wanted = dict(percentiles or {})
    if "median" in measures:
        wanted = {"median": 0.5, **wanted}

    per_key = Window.partitionBy(*keys)
    upward = per_key.orderBy("_price").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counts.withColumns(
        {
            "_total": F.sum("_n").over(per_key),
            "_mean": F.sum(F.col("_n") * F.col("_price")).over(per_key) / F.sum("_n").over(per_key),
            "_up_to": F.sum("_n").over(upward),
        }
    )
    if "mode" in measures or "mode_freq" in measures:
        counted = counted.withColumn("_ending", ending_price(F.col("_price"))).withColumn(
            "_freq", F.sum("_n").over(Window.partitionBy(*keys, "_ending"))
        )

    spread = F.sum(F.col("_n") * F.pow(F.col("_price") - F.col("_mean"), 2))
    most = F.struct("_freq", -F.col("_ending")) if "_freq" in counted.columns else None
    choices = {
        "avg": F.max("_mean"),
        "std": F.sqrt(F.try_divide(spread, F.max("_total") - 1)),
        "min": F.min("_price"),
        "max": F.max("_price"),
        "count": F.max("_total"),
    }
    if most is not None:
        choices["mode"] = F.max_by("_ending", most)
        choices["mode_freq"] = F.max("_freq")
    for name, share in wanted.items():
        # count-scaled shares keep the comparison in whole numbers
        reached = F.col("_up_to") * 10_000 >= F.col("_total") * round(share * 10_000)
        choices[name] = F.min(F.when(reached, F.col("_price")))

    names = [*measures, *(percentiles or {})]
    return counted.groupBy(*keys).agg(*(choices[m].alias(f"{prefix}_{m}") for m in names))


def two_period_stats(stats: DataFrame, then_prefix: str, now_prefix: str, gap: int = 2) -> DataFrame:
    """Statistics of week ``period - gap`` next to those of ``period``, per UPC.

    ``stats`` has one row per (upc, period); the later week may be missing.
    """
    from shelfwise.functions.weeks import shift_week

    values = [c for c in stats.columns if c not in ("upc", "period")]
    then = stats.select(
        "upc",
        shift_week(F.col("period"), -gap).alias("period"),
        *(F.col(c).alias(f"{then_prefix}_{c.split('_', 1)[1]}") for c in values),
    )
    now = stats.select(
        "upc", "period", *(F.col(c).alias(f"{now_prefix}_{c.split('_', 1)[1]}") for c in values)
    )
    return then.join(now, ["upc", "period"], "left")
