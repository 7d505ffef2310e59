"""Many weeks as one job: every table has the week it is run for as ``period``.

Each week has its own earlier week, look-back and as-of day, as if run alone; nothing loops
over weeks, and prices and stocks are read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.weeks import midweek_day
from shelfwise.operators.asof import asof_rows
from shelfwise.operators.dims import Catalogues
from shelfwise.operators.matching import OBSERVATION, central_prices, matrix_prices
from shelfwise.operators.pricestats import STORE_HISTORY_PERCENTILES, stats_of_counts
from shelfwise.operators.sliding import (
    in_windows,
    latest_in_windows,
    look_back_windows,
    merged_counts,
    run_periods,
    weekly_price_counts,
    weeks_back,
)
from shelfwise.plans.competitor_stats import (
    NATIONAL_MEASURES,
    RECENT_MEASURES,
    STORE_HISTORY_MEASURES,
    CompetitorStats,
)
from shelfwise.plans.fact_table import chosen_lines, fact_columns, fact_rows, near_upc, staged_lines
from shelfwise.session import apart, settled, stage

GAP = 2


def competitor_stats_by_week(
    prices: DataFrame, matrix: DataFrame, runs: DataFrame, first: int = 0, last: int = 6
) -> CompetitorStats:
    """``competitor_stats`` of every run in ``runs`` (period, maybe upc), from one scan of the prices."""
    windows = look_back_windows(near_upc(runs), first, last)
    counts = stage(weekly_price_counts(matrix_prices(prices, matrix), OBSERVATION, "comp_price"), "weekly_counts")
    weekly = stage(
        stats_of_counts(merged_counts(counts, ["upc", "period"]), ["upc", "period"], "market", NATIONAL_MEASURES),
        "weekly_national",
    )
    # dealt by UPC once each: what is made of them in a table staged ``together`` is not shuffled again
    counts, weekly = near_upc(counts), near_upc(weekly)
    now = weeks_back(weekly, windows, 0)
    national = weeks_back(weekly, windows, GAP).join(
        now.select("upc", "period", *(F.col(f"market_{m}").alias(f"market_now_{m}") for m in NATIONAL_MEASURES)),
        ["upc", "period"],
        "left",
    )
    recent = weekly.select("upc", "period", *(F.col(f"market_{m}").alias(f"recent_market_{m}") for m in RECENT_MEASURES))
    # prices of one observation and week, each as often as it occurs
    listed = counts.groupBy("period", *OBSERVATION).agg(
        F.flatten(F.collect_list(F.array_repeat("_price", F.col("_n").cast("int")))).alias("_prices")
    )
    return CompetitorStats(
        national=national,
        store_history=stats_of_counts(
            merged_counts(in_windows(counts, windows), ["period", *OBSERVATION]),
            ["period", *OBSERVATION],
            "hist",
            STORE_HISTORY_MEASURES,
            STORE_HISTORY_PERCENTILES,
        ),
        recent_national=latest_in_windows(recent, windows, ["upc"], "recent_market_period"),
        recent_store=latest_in_windows(listed, windows, OBSERVATION, "recent_period").select(
            "period", *OBSERVATION, "recent_period", F.explode("_prices").alias("comp_price_recent")
        ),
    )


def asof_inventory_by_week(inventory: DataFrame, lines: DataFrame) -> DataFrame:
    """Stock of each (sku, store, period) of ``lines`` as of the Friday of the week, with its date."""
    wanted = lines.select("sku", "store", "period").distinct().withColumn("_asof", midweek_day(F.col("period")))
    return asof_rows(wanted, inventory, ["sku", "store"], "_asof", "stock_date").drop("_asof")


def central_price_by_week(inventory: DataFrame, lines: DataFrame) -> DataFrame:
    return central_prices(asof_inventory_by_week(inventory, lines), ["period"])


def weekly_runs(
    sales: DataFrame,
    prices: DataFrame,
    inventory: DataFrame,
    cats: Catalogues,
    *,
    exclude: Sequence[int] = (),
    look_back: tuple[int, int] = (0, 6),
    fill_with_mode: bool = True,
    stats: CompetitorStats | None = None,
) -> DataFrame:
    """The fact table of every week of ``sales`` but those excluded."""
    by = ["period"]

    def known(lines: DataFrame) -> tuple[DataFrame, DataFrame, CompetitorStats]:
        # a run only looks back at the articles it has lines of
        demand = stage(lines.select("period", "upc").distinct(), "demand")
        made = stats
        if made is None:
            made = competitor_stats_by_week(prices, cats.matrix, demand, *look_back)
            made = replace(made, recent_store=near_upc(stage(made.recent_store, "recent_store", together=True)))
        windows = look_back_windows(near_upc(demand), 0, GAP).filter(F.col("back").isin(0, GAP))
        seen = near_upc(prices.filter(F.col("comp_price").isNotNull()).select("period", *OBSERVATION, "comp_price"))
        then, now = (weeks_back(seen, windows, back) for back in (GAP, 0))
        return then, now.withColumnRenamed("comp_price", "comp_price_now"), made

    def rows() -> DataFrame:
        lines = staged_lines(sales.join(run_periods(sales, exclude), "period", "left_semi"), cats)
        chosen = chosen_lines(lines, lambda: known(lines), cats, by)
        central = settled(lines.sparkSession, "central", lambda: central_price_by_week(inventory, lines))
        return fact_rows(lines, chosen, central, cats, by)

    return fact_columns(apart(sales.sparkSession, rows), cats, by, fill_with_mode=fill_with_mode)
