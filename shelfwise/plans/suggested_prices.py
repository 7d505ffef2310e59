"""Suggested price per article and store, with the logic of groups and exceptions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.prices import DEFAULT_PROMO_PERCENT, clearance_ending, ending_price
from shelfwise.operators.dims import Catalogues
from shelfwise.operators.groups import (
    GROUP_KEY,
    group_exceptions,
    group_prices,
    national_group_prices,
    split_exceptions,
)
from shelfwise.operators.joins import left_join_spread
from shelfwise.operators.matching import base_priority

NO_SPOT_PRIORITY = 10

# what a price came from: the competitor's row, and the row of its group
ORIGIN = ["sku", "priority", "comp_store", "comp_chain", "comp_source"]
REFERENCES = ["spot_price", "store_median", "national_median", "national_mode", "group_price", "group_median", "group_mode"]
PRICE_COLUMNS = [
    "store", "price_group", "upc", *ORIGIN, "suggested_price", "suggested_source", *REFERENCES, *(f"group_{c}" for c in ORIGIN)
]


@dataclass(frozen=True)
class SuggestedPrices:
    auxiliary: DataFrame
    rows: DataFrame

    @property
    def regular(self) -> DataFrame:
        return split_exceptions(self.rows)[0]

    @property
    def exceptional(self) -> DataFrame:
        return split_exceptions(self.rows)[1]


def single_prices(
    fact: DataFrame,
    *,
    flag_clearance_endings: bool = False,
    clearance_chains: Sequence[str] = schemas.CLEARANCE_CHAINS,
    ignore_national_mode: bool = True,
) -> DataFrame:
    """Price per article before groups: the recent competitor price unless it is a promotion."""
    c = F.col
    recent, mode, promo = c("comp_price_recent"), c("recent_market_mode"), c("comp_promo_recent")
    if flag_clearance_endings:
        marked = clearance_ending(recent) & (recent > mode) & c("comp_chain").isin(*clearance_chains)
        promo = F.when(marked, 1).otherwise(promo)
    # a promotion flag that is null keeps the price
    unusable = recent.isNull() | F.coalesce(promo == 1, F.lit(False))
    fallback, label = (None, None) if ignore_national_mode else (mode, schemas.NATIONAL_MODE)
    price = F.when(unusable, fallback).otherwise(recent)
    return fact.select(
        "sku", "upc", "dept", "subdept", "description", "store", "store_name",
        price.alias("suggested_price"),
        F.when(price.isNotNull(), F.when(unusable, label).otherwise(schemas.SPOT)).alias("suggested_source"),
        F.when(~unusable, base_priority(c("priority"))).otherwise(NO_SPOT_PRIORITY).alias("priority"),
        recent.alias("spot_price"),
        "comp_store",
        "comp_chain",
        c("comp_source_original").alias("comp_source"),
        c("hist_median").alias("store_median"),
        c("recent_market_median").alias("national_median"),
        mode.alias("national_mode"),
    )


def suggested_prices(
    fact: DataFrame,
    cats: Catalogues,
    *,
    flag_clearance_endings: bool = False,
    clearance_chains: Sequence[str] = schemas.CLEARANCE_CHAINS,
    ignore_national_mode: bool = True,
    top_priority_only: bool = True,
    drop_low_prices: bool = True,
    pool: str = "all",
) -> SuggestedPrices:
    c = F.col
    single = single_prices(
        fact,
        flag_clearance_endings=flag_clearance_endings,
        clearance_chains=clearance_chains,
        ignore_national_mode=ignore_national_mode,
    )
    rows = (
        single.join(cats.price_groups, "sku", "left")
        .join(cats.promo_limits, ["dept", "subdept"], "left")
        .fillna(DEFAULT_PROMO_PERCENT, ["promo_percent"])
    )
    shared = group_prices(rows, top_priority_only, drop_low_prices, pool).drop("group_store_median")

    own, group = c("suggested_price"), c("group_price")
    takes_group = c("price_group").isNotNull() & F.coalesce((own != group) | own.isNull(), F.lit(False))
    # rows without a group match nothing and must not meet in one task
    grouped = left_join_spread(rows, shared, GROUP_KEY, ["sku", "store"])
    grouped = left_join_spread(grouped, national_group_prices(rows), ["price_group"], ["sku", "store"])
    priced = grouped.withColumns(
        {
            "suggested_source": F.when(takes_group, schemas.GROUP).otherwise(c("suggested_source")),
            "suggested_price": F.when(takes_group, group).otherwise(own),
        }
    )
    if not ignore_national_mode:
        still_open = c("price_group").isNotNull() & c("suggested_price").isNull()
        priced = priced.withColumns(
            {
                "suggested_source": F.when(still_open, schemas.GROUP_MODE).otherwise(c("suggested_source")),
                "suggested_price": F.when(still_open, c("group_mode")).otherwise(c("suggested_price")),
            }
        )
    final = (
        priced.withColumn("suggested_price", ending_price(c("suggested_price")))
        .withColumn(
            "suggested_source", F.when(c("suggested_price").isNotNull(), c("suggested_source"))
        )
        .select(*PRICE_COLUMNS)
        .join(cats.exceptions, "sku", "left")
    )
    of_groups = group_exceptions(cats.exceptions, cats.price_groups)
    final = left_join_spread(final, of_groups, ["price_group"], ["sku", "store"])
    return SuggestedPrices(auxiliary=single, rows=final)
