"""Articles that must share one price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.prices import drop_flag
from shelfwise.operators.joins import left_join_spread

GROUP_KEY = ["store", "price_group"]


def group_exceptions(exceptions: DataFrame, price_groups: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """First exceptional article of each group, optionally only among given articles."""
    listed = exceptions.join(price_groups, "sku", "inner")
    if among is not None:
        listed = listed.filter(F.col("exception").isNotNull()).join(
            among.select("sku").distinct(), "sku", "left_semi"
        )
    first = F.min(F.struct("sku", "exception"))
    return (
        listed.groupBy("price_group")
        .agg(first.alias("_first"))
        .select(
            "price_group",
            F.col("_first.sku").alias("group_exception_sku"),
            F.col("_first.exception").alias("group_exception"),
        )
    )


def national_group_prices(rows: DataFrame) -> DataFrame:
    return (
        rows.filter(F.col("price_group").isNotNull())
        .groupBy("price_group")
        .agg(F.min("national_median").alias("group_median"), F.min("national_mode").alias("group_mode"))
    )


def group_prices(
    rows: DataFrame,
    top_priority_only: bool = True,
    drop_low_prices: bool = True,
    pool: str = "all",
) -> DataFrame:
    """One price per (store, group) and the row it came from.

    The median of the group is taken over its best priority (or all rows), prices far
    below it are dropped, and the smallest remaining one is the group price. ``pool``
    says whether that smallest price may come from "all" rows or "top_priority" ones.

    Equal rows are counted first, so windows run over the distinct prices of a group.
    """
    origin = F.struct("sku", "priority", "comp_store", "comp_chain", "comp_source")
    cells = (
        rows.filter(F.col("price_group").isNotNull() & F.col("suggested_price").isNotNull())
        .groupBy(*GROUP_KEY, "suggested_price", "priority", "promo_percent")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(origin).alias("_origin"))
    )
    group = Window.partitionBy(*GROUP_KEY)
    upward = group.orderBy("suggested_price").rangeBetween(Window.unboundedPreceding, Window.currentRow)

    cells = cells.withColumn(
        "_top",
        F.col("priority") == F.min("priority").over(group) if top_priority_only else F.lit(True),
    ).withColumn("_weight", F.when(F.col("_top"), F.col("_n")).otherwise(0))
    cells = cells.withColumn("_half", F.sum("_weight").over(upward) * 2 >= F.sum("_weight").over(group))
    cells = cells.withColumn(
        "group_store_median",
        F.min(F.when(F.col("_top") & F.col("_half"), F.col("suggested_price"))).over(group),
    )
    low = drop_flag(F.col("suggested_price"), F.col("group_store_median"), F.col("promo_percent").cast("double"))
    eligible = (low != 1) if drop_low_prices else F.lit(True)
    if pool == "top_priority":
        eligible = eligible & F.col("_top")
    elif pool != "all":
        raise ValueError(f"unknown pool: {pool}")
    cells = cells.withColumn("group_price", F.min(F.when(eligible, F.col("suggested_price"))).over(group))

    source = F.min(F.when(F.col("suggested_price") == F.col("group_price"), F.col("_origin")))
    return (
        cells.groupBy(*GROUP_KEY)
        .agg(
            F.max("group_store_median").alias("group_store_median"),
            F.max("group_price").alias("group_price"),
            source.alias("_source"),
        )
        .filter(F.col("group_price").isNotNull())
        .select(
            *GROUP_KEY,
            "group_store_median",
            "group_price",
            F.col("_source.sku").alias("group_sku"),
            F.col("_source.priority").alias("group_priority"),
            F.col("_source.comp_store").alias("group_comp_store"),
            F.col("_source.comp_chain").alias("group_comp_chain"),
            F.col("_source.comp_source").alias("group_comp_source"),
        )
    )


def group_min_prices(fact: DataFrame, price_groups: DataFrame) -> DataFrame:
    """Early rule: recent price, else the market median; then the group minimum per store."""
    from shelfwise.functions.prices import ending_price

    priced = fact.select(
        "sku", "store", F.coalesce("comp_price_recent", "market_median").alias("suggested_price")
    ).join(price_groups, "sku", "left")
    least = (
        priced.filter(F.col("price_group").isNotNull())
        .groupBy(*GROUP_KEY)
        .agg(F.min("suggested_price").alias("group_price"))
    )
    price = F.when(
        (F.col("suggested_price") > F.col("group_price")) | F.col("suggested_price").isNull(),
        F.col("group_price"),
    ).otherwise(F.col("suggested_price"))
    return left_join_spread(priced, least, GROUP_KEY, ["sku", "store"]).select(
        "sku", "price_group", "store", ending_price(price).alias("suggested_price")
    )


def split_exceptions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(regular, exceptional) rows by their own or their group's exception."""
    regular = F.col("exception").isNull() & F.col("group_exception").isNull()
    return rows.filter(regular), rows.filter(~regular)
