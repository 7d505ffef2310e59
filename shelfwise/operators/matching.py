"""Matching own articles to competitor stores, inventories and fallback prices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.picks import latest_rows, one_per_key

OBSERVATION = ["upc", "comp_store", "comp_source"]

# Added to a priority for each missing price, so that a lower penalty
# always beats any base priority (which stays under 100).
MISSING_THEN = 10_000
MISSING_NOW = 1_000
MISSING_RECENT = 100


def matrix_prices(prices: DataFrame, matrix: DataFrame) -> DataFrame:
    """Non-null prices of the competitor stores named in the matrix."""
    named = matrix.select("comp_store", "comp_source").distinct()
    return prices.filter(F.col("comp_price").isNotNull()).join(
        named, ["comp_store", "comp_source"], "left_semi"
    )


def matrix_expand(sales: DataFrame, matrix: DataFrame) -> DataFrame:
    """Every sales row with each ranked competitor store of its store and department."""
    return sales.join(matrix, ["store", "dept", "subdept"], "inner")


def base_priority(priority: Column) -> Column:
    return F.pmod(priority, F.lit(100))


def priority_pick(
    demand: DataFrame,
    matrix: DataFrame,
    then: DataFrame,
    now: DataFrame,
    recent: DataFrame,
    by: Sequence[str] = (),
) -> DataFrame:
    """Best competitor store per (store, upc): least penalised priority, ties kept.

    The choice only depends on store, UPC and department, so it is made on the distinct
    combinations of those. That keeps the ranking window bounded by departments ×
    priorities however many sales rows share a UPC, and leaves one join back to sales.
    ``then``, ``now`` and ``recent`` hold the observations of the earlier week, the
    current week and the look-back, keyed by upc, comp_store, comp_source. With ``by`` all
    tables have these columns as well and the choice is made for each of their values.
    """

    def seen(prices: DataFrame, flag: str) -> DataFrame:
        return prices.select(*by, *OBSERVATION).distinct().withColumn(flag, F.lit(True))

    options = matrix_expand(demand.select(*by, "store", "dept", "subdept", "upc").distinct(), matrix)
    for prices, flag in ((then, "_then"), (now, "_now"), (recent, "_recent")):
        options = options.join(seen(prices, flag), [*by, *OBSERVATION], "left")
    penalty = sum(
        F.when(F.col(flag).isNull(), cost).otherwise(0)
        for flag, cost in (("_then", MISSING_THEN), ("_now", MISSING_NOW), ("_recent", MISSING_RECENT))
    )
    best = F.rank().over(Window.partitionBy(*by, "store", "upc").orderBy("priority"))
    return (
        options.withColumn("priority", F.col("priority") + penalty)
        .withColumn("_place", best)
        .filter(F.col("_place") == 1)
        .drop("_place", "_then", "_now", "_recent")
    )


def latest_price_per_store(prices: DataFrame) -> DataFrame:
    """Most recent prices of each (upc, comp_store, comp_source)."""
    latest = latest_rows(prices.filter(F.col("comp_price").isNotNull()), OBSERVATION, "period")
    return latest.select(
        *OBSERVATION, F.col("period").alias("recent_period"), F.col("comp_price").alias("comp_price_recent")
    )


def central_prices(inventory: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return inventory.select(
        *by,
        "sku",
        "store",
        F.try_divide("stock_value", "stock_units").alias("central_price"),
        "stock_units",
        "stock_value",
        "stock_cost",
    )


def asof_inventory(inventory: DataFrame, day: date) -> DataFrame:
    """Latest inventory rows of each article and store dated up to ``day``."""
    known = inventory.filter(F.col("stock_date") <= F.lit(day))
    return latest_rows(known, ["sku", "store"], "stock_date")


def newest_inventory(inventory: DataFrame) -> DataFrame:
    """Latest inventory rows of each article and store, however late; undated ones where there are no others."""
    dated = inventory.withColumn("_day", F.coalesce("stock_date", F.lit("0001-01-01").cast("date")))
    return latest_rows(dated, ["sku", "store"], "_day").drop("_day")


def central_price_asof(inventory: DataFrame, day: date) -> DataFrame:
    return central_prices(asof_inventory(inventory, day))


def central_price_snapshot(inventory: DataFrame) -> DataFrame:
    """Central price of a single snapshot, one row per article and store."""
    columns = ["stock_units", "stock_value", "stock_cost"]
    return central_prices(one_per_key(inventory.drop("stock_date"), ["sku", "store"], columns))


def latest_snapshot(inventory: DataFrame, day: date, by: str = "snapshot_date") -> DataFrame:
    """All rows of the newest snapshot not after ``day``."""
    known = inventory.filter(F.col(by) <= F.lit(day))
    newest = known.agg(F.max(by).alias(by))
    return known.join(newest, by, "left_semi")


def store_membership(left: DataFrame, right: DataFrame, key: str = "store") -> DataFrame:
    """Each key with where it occurs: both, left or right. Ids that are no numbers are dropped."""

    def ids(df: DataFrame, flag: str) -> DataFrame:
        number = F.col(key).cast("string").try_cast("int")
        return df.select(number.alias(key)).filter(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(1))

    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("both")
    return ids(left, "_l").join(ids(right, "_r"), key, "full").select(key, side.alias("found_in"))


def join_retention(sales: DataFrame, matrix: DataFrame, now: DataFrame, then: DataFrame) -> DataFrame:
    """Stores left after joining sales to the matrix, to this week's and to the earlier prices."""
    demand = sales.select("store", "dept", "subdept", "upc").distinct()
    options = demand.join(matrix.withColumn("_in_matrix", F.lit(True)), ["store", "dept", "subdept"], "left")
    for prices, flag in ((now, "_now"), (then, "_then")):
        options = options.join(
            prices.select(*OBSERVATION).distinct().withColumn(flag, F.lit(True)), OBSERVATION, "left"
        )
    in_matrix = F.col("_in_matrix").isNotNull()
    with_now = in_matrix & F.col("_now").isNotNull()
    # one row per store first, so nothing has to be counted distinct
    per_store = options.groupBy("store").agg(
        F.bool_or(in_matrix).alias("matrix"),
        F.bool_or(with_now).alias("now"),
        F.bool_or(with_now & F.col("_then").isNotNull()).alias("then"),
    )
    return per_store.agg(
        F.count("store").alias("stores_with_sales"),
        F.count_if("matrix").alias("stores_in_matrix"),
        F.count_if("now").alias("stores_with_prices_now"),
        F.count_if("then").alias("stores_with_both_weeks"),
    )


def reconcile_names(matrix: DataFrame, feeds: list[DataFrame], key: str) -> DataFrame:
    """Matrix names next to the names found in the price feeds; unmatched ones stay with null."""
    found = feeds[0].select(key)
    for feed in feeds[1:]:
        found = found.unionByName(feed.select(key))
    found = found.distinct().withColumn(f"{key}_in_feeds", F.col(key))
    return matrix.select("store", key).join(found, key, "left").withColumnRenamed(key, f"{key}_in_matrix")


def inventory_universe(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Every (store, sku) in stock with its sales, if any."""
    return inventory.select("store", "sku").distinct().join(sales, ["store", "sku"], "left")
