"""Sums over weeks, roll-ups of the fact table, coverage of stores and weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.weeks import week_before
from shelfwise.operators.picks import top_per_key, top_rows
from shelfwise.operators.ranking import quantile_cuts

NINE_KEYS = [
    "period", "region", "dept", "subdept", "national_decile",
    "clearance", "comp_clearance_now", "promo", "comp_promo_now",
]
FLAGS = ["clearance", "comp_clearance_now", "promo", "comp_promo_now"]


def sales_sum_weeks(sales: DataFrame, skus: DataFrame, period: int, weeks: int) -> DataFrame:
    """Sales of ``weeks`` weeks up to ``period`` per article and store."""
    window = F.col("period").between(week_before(period, weeks - 1), period)
    return (
        sales.filter(window)
        .groupBy("sku", "store")
        .agg(F.sum("amount").alias("total_amount"), F.sum("units").alias("total_units"))
        .join(skus.select("sku", "dept", "subdept", "class_id", "subclass_id"), "sku", "left")
    )


def as_sales(sums: DataFrame) -> DataFrame:
    """A multi-week sum in the columns of weekly sales."""
    return sums.withColumnsRenamed({"total_amount": "amount", "total_units": "units"})


def rollup_nine_keys(fact: DataFrame) -> DataFrame:
    """Sums and counts of articles and stores.

    Rows are summed by article and store first, so the distinct counts multiply these only.
    """
    summed = ["amount", "amount_gross", "comp_sales", "comp_sales_now", "comp_now_minus_sales", "units"]
    pairs = fact.groupBy(*NINE_KEYS, "upc", "store").agg(
        F.min("dept_name").alias("dept_name"),
        F.min("subdept_name").alias("subdept_name"),
        *(F.sum(c).alias(c) for c in summed),
    )
    return pairs.groupBy(*NINE_KEYS).agg(
        F.min("dept_name").alias("dept_name"),
        F.min("subdept_name").alias("subdept_name"),
        *(F.sum(c).alias(f"sum_{c}") for c in summed),
        F.count_distinct("upc").alias("articles"),
        F.count_distinct("store").alias("stores"),
    )


def rollup_flags(rolled: DataFrame) -> DataFrame:
    """Difference to competitor sales by all four flags and by the two promotion flags.

    ``level`` tells the two apart; the second is in millions.
    """
    total = F.sum("sum_comp_now_minus_sales")
    by_two = F.grouping("clearance") == 1
    return (
        rolled.groupingSets([[F.col(c) for c in FLAGS], [F.col("promo"), F.col("comp_promo_now")]], *FLAGS)
        .agg(F.when(by_two, total / 1e6).otherwise(total).alias("difference"), F.max(by_two).alias("_two"))
        .withColumn("level", F.when(F.col("_two"), "promo").otherwise("all"))
        .drop("_two")
    )


def price_change_distribution(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Relative distance of current competitor prices from the store median, per key, with exact cuts."""
    now = F.try_divide("comp_sales_now", "units")
    change = F.try_divide(now - F.col("hist_median"), F.col("hist_median"))
    rows = fact.select(*keys, "dept_name", change.alias("change"))
    plain = [
        F.min("dept_name").alias("dept_name"),
        F.avg("change").alias("change_avg"),
        F.min("change").alias("change_min"),
        F.max("change").alias("change_max"),
    ]
    cuts = quantile_cuts(rows, keys, ["change"], [i / 10 for i in range(11)], plain)
    return cuts.select("*", *(F.col("change_cuts")[i].alias(f"p{i}0") for i in (0, 1, 2, 8, 9))).drop("change_cuts")


def store_period_coverage(
    sales: DataFrame, stores: DataFrame, periods: Sequence[int] | None = None
) -> DataFrame:
    """Row count of every catalogue store in each of ``periods``, null where a store is missing.

    Without ``periods`` all weeks of ``sales`` count; these few numbers are read first.
    """
    if periods is None:
        periods = [r.period for r in sales.select("period").distinct().orderBy("period").collect()]
    counts = sales.groupBy("store", "period").agg(F.count(F.lit(1)).alias("rows"))
    weeks = F.array(*(F.lit(p) for p in periods))
    grid = stores.select("store").distinct().withColumn("period", F.explode(weeks))
    return grid.join(counts, ["store", "period"], "left")


def top_skus_per_decile(fact: DataFrame, deciles: int = 5, n: int = 2) -> DataFrame:
    """Best-selling articles of each of the first national deciles."""
    totals = (
        fact.filter(F.col("national_decile").isNotNull())
        .groupBy("sku")
        .agg(F.sum("amount_gross").alias("sales"), F.min("national_decile").alias("decile"))
        .filter(F.col("decile").between(1, deciles))
    )
    return top_per_key(totals, ["decile"], [F.desc("sales"), F.asc("sku")], n).select(
        "decile", "place", "sku", "sales"
    )


def store_sales(fact: DataFrame) -> DataFrame:
    """Gross sales per store and the competitor chain met first by name."""
    return fact.groupBy("store").agg(
        F.min("comp_chain").alias("comp_chain"), F.sum("amount_gross").alias("sales")
    )


def top_stores(fact: DataFrame, n: int = 20) -> DataFrame:
    return top_rows(store_sales(fact), [F.desc("sales"), F.asc("store")], n)


def restricted_extract(fact: DataFrame, skus: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows of listed articles in listed stores. Lists are tables, so they may be long."""
    return fact.join(skus.select("sku").distinct(), "sku", "left_semi").join(
        stores.select("store").distinct(), "store", "left_semi"
    )
