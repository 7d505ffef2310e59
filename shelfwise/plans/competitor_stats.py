"""Competitor price statistics of one week and its look-back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.weeks import week_before
from shelfwise.operators.matching import OBSERVATION, latest_price_per_store, matrix_prices
from shelfwise.operators.picks import latest_rows
from shelfwise.operators.pricestats import STORE_HISTORY_PERCENTILES, price_stats, two_period_stats

NATIONAL_MEASURES = ("avg", "std", "median", "mode", "mode_freq")
RECENT_MEASURES = ("avg", "median", "mode", "mode_freq")
STORE_HISTORY_MEASURES = ("avg", "std", "min", "max", "median")


@dataclass(frozen=True)
class CompetitorStats:
    national: DataFrame  # upc: week -2 next to the current week
    store_history: DataFrame  # upc, comp_store, comp_source
    recent_national: DataFrame  # upc: latest week with prices
    recent_store: DataFrame  # upc, comp_store, comp_source: latest prices


def national_price_stats(prices: DataFrame, prefix: str = "market") -> DataFrame:
    """Statistics of every (upc, period)."""
    return price_stats(prices, ["upc", "period"], "comp_price", prefix, NATIONAL_MEASURES)


def national_two_periods(prices: DataFrame) -> DataFrame:
    return two_period_stats(national_price_stats(prices), "market", "market_now")


def store_price_history(prices: DataFrame) -> DataFrame:
    return price_stats(
        prices,
        OBSERVATION,
        "comp_price",
        "hist",
        STORE_HISTORY_MEASURES,
        STORE_HISTORY_PERCENTILES,
    )


def recent_national_stats(prices: DataFrame) -> DataFrame:
    known = prices.filter(F.col("comp_price").isNotNull())
    latest = latest_rows(known, ["upc"], "period")
    return price_stats(
        latest, ["upc", "period"], "comp_price", "recent_market", RECENT_MEASURES
    ).withColumnRenamed("period", "recent_market_period")


def look_back(prices: DataFrame, period: int, first: int = 0, last: int = 6) -> DataFrame:
    """Prices of the weeks ``period - last`` to ``period - first``, in either order."""
    near, far = sorted((first, last))
    return prices.filter(F.col("period").between(week_before(period, far), week_before(period, near)))


def look_back_prices(
    prices: DataFrame, matrix: DataFrame, period: int, first: int = 0, last: int = 6
) -> DataFrame:
    """What all statistics start from; worth staging, as four tables are made of it."""
    return matrix_prices(look_back(prices, period, first, last), matrix)


def competitor_stats(base: DataFrame, period: int) -> CompetitorStats:
    """The four tables of the week ``period`` from its ``look_back_prices``."""
    two_weeks = base.filter(F.col("period").isin(week_before(period, 2), period))
    return CompetitorStats(
        national=national_two_periods(two_weeks).filter(F.col("period") == period).drop("period"),
        store_history=store_price_history(base),
        recent_national=recent_national_stats(base),
        recent_store=latest_price_per_store(base),
    )


def competitor_upcs(prices: DataFrame, period: int, weeks: int) -> DataFrame:
    return look_back(prices, period, 0, weeks - 1).select("upc").distinct()
