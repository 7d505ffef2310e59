"""Descriptive report on the sales of a week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.prices import gross, unit_price

ITEM = ["sku", "upc", "period"]


def gross_sales(sales: DataFrame, taxes: DataFrame) -> DataFrame:
    c = F.col
    price = unit_price(c("amount"), c("units"))
    return (
        sales.filter(c("upc").isNotNull())
        .join(taxes, "sku", "inner")
        .withColumns(
            {
                "amount_gross": gross(c("amount"), c("iva"), c("ieps")),
                "price_gross": gross(price, c("iva"), c("ieps")),
            }
        )
    )


def weekly_counts(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(F.col("upc").isNotNull())
        .groupBy("period")
        .agg(F.count_distinct("store").alias("stores"), F.count_distinct("upc").alias("articles"))
    )


def store_totals(taxed: DataFrame, stores: DataFrame) -> DataFrame:
    return (
        taxed.groupBy("store", "period")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum("amount_gross").alias("amount_gross"),
            F.count("upc").alias("articles"),
        )
        .join(stores, "store", "left")
    )


def item_stats(taxed: DataFrame) -> DataFrame:
    return taxed.groupBy(*ITEM).agg(
        F.sum("amount").alias("amount"),
        F.sum("amount_gross").alias("amount_gross"),
        F.count("store").alias("stores"),
        F.avg("price_gross").alias("price_avg"),
        F.min("price_gross").alias("price_min"),
        F.max("price_gross").alias("price_max"),
        F.coalesce(F.stddev("price_gross"), F.lit(0.0)).alias("price_std"),
    )


def extreme_price_stores(taxed: DataFrame) -> DataFrame:
    """Stores with the lowest and the highest price of each item, joined by ``:``.

    Stores are first gathered per distinct price and only the two outer lists survive.
    A store appears once per item, so a list is never longer than the chain.
    """
    lists = (
        taxed.filter(F.col("price_gross").isNotNull())
        .groupBy(*ITEM, "price_gross")
        .agg(F.concat_ws(":", F.array_sort(F.collect_list("store"))).alias("_stores"))
    )
    return lists.groupBy(*ITEM).agg(
        F.min_by("_stores", "price_gross").alias("stores_min"),
        F.max_by("_stores", "price_gross").alias("stores_max"),
    )


def item_report(taxed: DataFrame, skus: DataFrame) -> DataFrame:
    return (
        item_stats(taxed)
        .join(extreme_price_stores(taxed), ITEM, "left")
        .join(skus, ["sku", "upc"], "left")
    )
