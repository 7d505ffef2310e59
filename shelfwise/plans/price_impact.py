"""What the suggested prices would cost, and the reports on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.prices import ending_price, gross, percent_of, unit_price
from shelfwise.operators.dims import Catalogues
from shelfwise.operators.groups import group_exceptions
from shelfwise.operators.joins import left_join_spread
from shelfwise.operators.matching import central_price_snapshot
from shelfwise.plans.suggested_prices import PRICE_COLUMNS

# Status codes left out of the impact.
INACTIVE_STATUS = ("P", "AT")
# Store ids outside the scope of the impact.
CLOSED_RANGE = (300, 499)
CLOSED_STORES = (686, 687)

GROUP_FIELDS = ["price", "sku", "priority", "comp_store", "comp_chain", "comp_source"]


def in_store_scope(
    store: Column,
    closed_range: tuple[int, int] = CLOSED_RANGE,
    closed_stores: Sequence[int] = CLOSED_STORES,
) -> Column:
    low, high = closed_range
    return ~store.between(low, high) & ~store.isin(*closed_stores)


def gross_prices(rows: DataFrame) -> DataFrame:
    """Central and average price with taxes, on an allowed ending."""
    c = F.col
    net = ending_price(c("central_price"))
    average = unit_price(c("amount"), c("units"), positive_only=True)
    return rows.withColumns(
        {
            "central_price_gross": ending_price(gross(net, c("iva"), c("ieps"))),
            "avg_price_gross": ending_price(gross(average, c("iva"), c("ieps"))),
        }
    ).drop("central_price", "amount", "units", "iva", "ieps")


def open_articles(cats: Catalogues, excluded_groups: DataFrame) -> DataFrame:
    """Active articles outside exceptions, with all that is known per article.

    An article missing from the catalogue has no status and is left out like inactive ones.
    """
    exceptional = cats.exceptions.filter(F.col("exception").isNotNull())
    return (
        cats.skus.drop("upc")
        .filter(~F.col("status").isin(*INACTIVE_STATUS))
        .join(exceptional, "sku", "left_anti")
        .join(cats.price_groups, "sku", "left")
        .join(excluded_groups, "price_group", "left_anti")
        .join(cats.taxes, "sku", "left")
        .join(cats.national_deciles.drop("upc"), "sku", "left")
    )


@dataclass(frozen=True)
class Contingency:
    """Prices to fall back on where an article has none in a store."""

    by_sku: DataFrame
    by_group_store: DataFrame
    by_group: DataFrame


def contingency(prices: DataFrame) -> Contingency:
    c = F.col

    def first_of(keys: list[str], known: Column, fields: list[str]) -> DataFrame:
        return (
            prices.filter(known)
            .groupBy(*keys)
            .agg(F.min(F.struct(*fields)).alias("_f"))
            .select(*keys, *(c(f"_f.{f}").alias(f"other_{f}") for f in fields))
        )

    has_group = c("price_group").isNotNull()
    return Contingency(
        by_sku=first_of(["sku"], c("national_median").isNotNull(), ["national_median", "national_mode"]),
        by_group_store=first_of(
            ["price_group", "store"],
            c("group_price").isNotNull() & has_group,
            [f"group_{f}" for f in GROUP_FIELDS],
        ),
        by_group=first_of(
            ["price_group"], c("group_median").isNotNull() & has_group, ["group_median", "group_mode"]
        ),
    )


def fill_contingency(rows: DataFrame, other: Contingency) -> DataFrame:
    joined = rows.join(other.by_sku, "sku", "left")
    # most articles have no price group
    joined = left_join_spread(joined, other.by_group_store, ["price_group", "store"], ["sku", "store"])
    joined = left_join_spread(joined, other.by_group, ["price_group"], ["sku", "store"])
    spare = [c for c in joined.columns if c.startswith("other_")]
    return joined.withColumns(
        {c[6:]: F.coalesce(F.col(c[6:]), F.col(c)) for c in spare}
    ).drop(*spare)


def fall_back(rows: DataFrame, ignore_national_mode: bool = True) -> DataFrame:
    """Suggested price, else the group's, else (if allowed) the group and national modes."""
    c = F.col
    steps = [("group_price", schemas.GROUP)]
    if not ignore_national_mode:
        steps += [("group_mode", schemas.GROUP_MODE), ("national_mode", schemas.NATIONAL_MODE)]
    label = F.when(c("suggested_price").isNotNull(), c("suggested_source"))
    for name, source in steps:
        label = label.when(c(name).isNotNull(), source)
    price = F.coalesce("suggested_price", *(name for name, _ in steps))
    return rows.withColumns({"suggested_source": label, "suggested_price": price})


@dataclass(frozen=True)
class PriceImpact:
    rows: DataFrame
    group_exceptions: DataFrame


def price_impact(
    prices: DataFrame,
    inventory: DataFrame,
    sales: DataFrame,
    cats: Catalogues,
    *,
    how: str = "left",
    ignore_national_mode: bool = True,
    scope: Column | None = None,
) -> PriceImpact:
    """Impact of ``prices`` (regular and exceptional rows together) on the stock.

    ``sales`` are those of a week, or a multi-week sum. ``how`` is "left" to keep the
    stocked pairs, "full" to keep sales without stock as well.
    """
    c = F.col
    scope = in_store_scope(c("store")) if scope is None else scope
    prices = prices.select(*PRICE_COLUMNS)
    stock = (
        central_price_snapshot(inventory)
        .filter(scope)
        .select("sku", "store", "stock_units", "stock_value", "central_price")
    )
    by_group = group_exceptions(cats.exceptions, cats.price_groups, among=stock)

    # joins on (sku, store) follow each other, so the stock is shuffled for them once; the
    # article's own data is joined as one table that already leaves out closed articles
    rows = (
        stock.join(sales.select("sku", "store", "amount", "units"), ["sku", "store"], how)
        .join(prices.drop("price_group"), ["sku", "store"], "left")
        .join(open_articles(cats, by_group), "sku", "inner")
    )
    rows = fall_back(fill_contingency(gross_prices(rows), contingency(prices)), ignore_national_mode)
    rows = rows.withColumn("suggested_price", ending_price(c("suggested_price"))).withColumns(
        {
            "impact_vs_central": c("stock_units") * (c("suggested_price") - c("central_price_gross")),
            "impact_vs_average": c("stock_units") * (c("suggested_price") - c("avg_price_gross")),
        }
    )
    unset = {
        "exception": "string",
        "group_exception_sku": by_group.schema["group_exception_sku"].dataType,
        "group_exception": "string",
    }
    rows = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in unset.items()})
    return PriceImpact(rows=rows.join(cats.stores, "store", "left"), group_exceptions=by_group)


# Reports


def null_suggestion_skus(impact: PriceImpact, cats: Catalogues) -> DataFrame:
    """Articles without a price somewhere; ``all_null`` is 1 if they have none anywhere."""
    some, none = F.count("suggested_price"), F.count_if(F.col("suggested_price").isNull())
    return (
        impact.rows.groupBy("sku")
        .agg(F.when(some == 0, 1).otherwise(0).alias("all_null"), none.alias("_nulls"))
        .filter(F.col("_nulls") > 0)
        .drop("_nulls")
        .join(cats.price_groups, "sku", "left")
        .join(impact.group_exceptions, "price_group", "left")
        .join(cats.skus, "sku", "left")
    )


def _impact_sums() -> list[Column]:
    return [
        F.sum("impact_vs_central").alias("impact_vs_central"),
        F.sum("impact_vs_average").alias("impact_vs_average"),
    ]


def impact_by_sku(rows: DataFrame, cats: Catalogues) -> DataFrame:
    return (
        rows.groupBy("sku", "upc")
        .agg(*_impact_sums())
        .join(cats.skus.drop("upc"), "sku", "left")
        .join(cats.national_deciles.drop("upc"), "sku", "left")
    )


def impact_by_store(rows: DataFrame, cats: Catalogues) -> DataFrame:
    return rows.groupBy("store").agg(*_impact_sums()).join(cats.stores, "store", "left")


def coverage_by_subdept(rows: DataFrame, require_both: bool = False) -> DataFrame:
    """Regulated share per store and sub-department.

    ``require_both`` keeps only groups that have priced and unpriced articles.
    """
    priced = F.col("suggested_price").isNotNull()
    out = (
        rows.groupBy("store", "dept", "subdept")
        .agg(
            F.count_if(priced).alias("priced"),
            F.count_if(~priced).alias("unpriced"),
            *(
                F.sum(F.when(priced, F.col(c))).alias(c)
                for c in ("impact_vs_central", "impact_vs_average")
            ),
        )
        .withColumn("percent_regulated", percent_of(F.col("priced"), F.col("priced") + F.col("unpriced")))
    )
    return out.filter((F.col("priced") > 0) & (F.col("unpriced") > 0)) if require_both else out


def suggestion_counts(rows: DataFrame) -> DataFrame:
    """Rows by store, priority and source; the priority only counts for spot prices."""
    priority = F.when(F.col("suggested_source") == schemas.SPOT, F.coalesce("priority", F.lit(0))).otherwise(0)
    return rows.groupBy("store", priority.alias("priority"), "suggested_source").agg(
        F.count("sku").alias("n")
    )


def promo_fallback_report(rows: DataFrame) -> DataFrame:
    """Rows that took a national price although a spot price exists."""
    national = F.col("suggested_source").isin(schemas.NATIONAL_MODE, schemas.NATIONAL_MEDIAN)
    return rows.filter(national & F.col("spot_price").isNotNull())


def regulated_counts(rows: DataFrame) -> DataFrame:
    """Articles with a price next to all articles, per store and sub-department."""
    return rows.groupBy("store", "dept", "subdept").agg(
        F.count_if(F.col("suggested_price").isNotNull()).alias("regulated"), F.count("sku").alias("articles")
    )
