"""Look-backs of many weeks at once.

Which week a run looks back at is a small table of runs and offsets; joining weekly rows to it by
week gives each run its window, wherever years begin. Statistics of windows are sums of weekly price
counts, so prices are read and counted once, however many runs look back at them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.weeks import shift_week
from shelfwise.operators.pricestats import price_counts


def run_periods(sales: DataFrame, exclude: Sequence[int] = ()) -> DataFrame:
    """The weeks to run: all on record but those excluded."""
    return sales.select(F.col("period").cast("int").alias("period")).filter(F.col("period").isNotNull() & ~F.col("period").isin(*exclude)).distinct()


def look_back_windows(runs: DataFrame, first: int = 0, last: int = 6) -> DataFrame:
    """(period, ..., back, seen_period): each run with the weeks ``first`` to ``last`` before it.

    ``runs`` may name more keys, such as the articles that a run needs; only their rows are looked at then.
    """
    near, far = sorted((first, last))
    return runs.withColumn("back", F.explode(F.sequence(F.lit(near), F.lit(far)))).withColumn(
        "seen_period", shift_week(F.col("period"), F.col("back"))
    )


def in_windows(weekly: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of ``weekly`` (period, ...) once for each run that looks back at their week.

    ``period`` is the run then, ``seen_period`` the week of the row, ``back`` the weeks between.
    """
    keys = [c for c in windows.columns if c not in ("period", "back")]
    return weekly.withColumnRenamed("period", "seen_period").join(windows, keys, "inner")


def weeks_back(weekly: DataFrame, windows: DataFrame, back: int) -> DataFrame:
    """Rows of the single week ``back`` weeks before each run."""
    return in_windows(weekly, windows.filter(F.col("back") == back)).drop("seen_period", "back")


def weekly_price_counts(prices: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """How often each price of a key occurs in each week."""
    return price_counts(prices, ["period", *keys], price)


def merged_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts summed by fewer keys, or over the weeks of a window."""
    return counts.groupBy(*keys, "_price").agg(F.sum("_n").alias("_n"))


def latest_in_windows(weekly: DataFrame, windows: DataFrame, keys: Sequence[str], seen: str) -> DataFrame:
    """Of each run and key the row of the latest week looked back at, its week as ``seen``.

    ``weekly`` has one row per key and week. A plain aggregate, reduced map side.
    """
    values = [c for c in weekly.columns if c not in ("period", *keys)]
    latest = in_windows(weekly, windows).groupBy("period", *keys).agg(
        F.max(F.col("seen_period")).alias(seen), F.max_by(F.struct(*values), "seen_period").alias("_row")
    )
    return latest.select("period", *keys, seen, *(F.col(f"_row.{c}").alias(c) for c in values))
