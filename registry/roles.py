"""The supplied tables seen as sales, competitor prices, inventories and catalogues.

Amounts are summed as whole numbers of hundredths of a cent, so they come out the same
whatever the order of the sum.
"""

from __future__ import annotations

from dataclasses import fields
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.weeks import midweek_date, week_of
from shelfwise.operators import dims
from shelfwise.operators.matching import asof_inventory, newest_inventory
from shelfwise.operators.sliding import run_periods
from shelfwise.plans.competitor_stats import CompetitorStats, competitor_stats, look_back_prices
from shelfwise.plans.fact_table import fact_table
from shelfwise.plans.price_impact import PriceImpact, price_impact
from shelfwise.plans.suggested_prices import suggested_prices
from shelfwise.plans.weekly_runs import competitor_stats_by_week, weekly_runs
from shelfwise.session import lasting, settled, stage, tune

STORES = 20

_STAGED: dict[tuple, DataFrame] = {}


def cents(x: Column) -> Column:
    return F.floor(x * 100 + 0.5)


def _tenth(x: Column) -> Column:
    return F.floor(x / 10).cast("long")


class _Once:
    """A value made on first use."""

    def __init__(self, make):
        self._make = make

    @cached_property
    def value(self):
        return self._make()


class _StagedCatalogues:
    """The fields of ``Catalogues``, each written when it is first used."""

    def __init__(self, roles: Roles):
        self._roles = roles

    def __getattr__(self, name: str) -> DataFrame:
        return self._roles.staged(f"catalogue_{name}", lambda: getattr(self._roles.lazy_cats, name))


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        c = F.col
        day = c("l_shipdate").cast("date")
        return self.table("lineitem").select(
            week_of(day).alias("period"),
            day.alias("day"),
            c("l_partkey").alias("sku"),
            _tenth(c("l_partkey")).alias("upc"),
            (c("l_suppkey") % STORES).cast("int").alias("store"),
            "l_suppkey",
            "l_returnflag",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
        )

    @cached_property
    def _span(self) -> tuple[int, int]:
        """The last week on record and how many weeks back the first one lies, read once."""
        week = week_of(F.col("l_shipdate").cast("date"))
        first, last = self.table("lineitem").agg(F.min(week), F.max(week)).first()
        monday = lambda w: midweek_date(w) - timedelta(days=4)
        return last, (monday(last) - monday(first)).days // 7

    @property
    def run_period(self) -> int:
        """The week of the run: the last on record."""
        return self._span[0]

    @property
    def look_back(self) -> int:
        """Weeks that reach before the first on record, so that runs use all of them."""
        return self._span[1] + 1

    # Facts, as the weekly files would hold them

    @cached_property
    def lazy_prices(self) -> DataFrame:
        unit = cents(F.col("l_extendedprice") / F.col("l_quantity"))
        store = F.col("store")
        return (
            self.lines.filter(F.col("l_returnflag") != "R")
            .groupBy("period", "upc", store.alias("comp_store"))
            .agg((F.min(unit) / 100).alias("comp_price"))
            .withColumn("comp_source", F.concat(F.lit("S"), (F.col("comp_store") % 3).cast("string")))
        )

    def _sales_by(self, *keys: str) -> DataFrame:
        price = cents(F.col("l_extendedprice"))
        discount = cents(F.col("l_discount"))
        return (
            self.lines.filter(F.col("l_returnflag") == "R")
            .groupBy(*keys)
            .agg(
                F.sum(F.col("l_quantity").cast("long")).cast("double").alias("units"),
                (F.sum(price * (100 - discount)) / 10000).alias("amount"),
                (F.sum(price) * 7 / 1000).alias("cost"),
            )
        )

    @cached_property
    def lazy_sales(self) -> DataFrame:
        return self._sales_by("period", "sku", "store")

    @cached_property
    def sales_with_hierarchy(self) -> DataFrame:
        return self.sales.join(
            self.cats.skus.select("sku", "upc", "dept", "subdept", "class_id", "subclass_id"), "sku", "inner"
        )

    @cached_property
    def lazy_inventory(self) -> DataFrame:
        price = cents(F.col("l_extendedprice"))
        return self.lines.groupBy("sku", "store", F.col("day").alias("stock_date")).agg(
            F.sum(F.col("l_quantity").cast("long")).cast("double").alias("stock_units"),
            (F.sum(price) / 100).alias("stock_value"),
            (F.sum(price) * 7 / 1000).alias("stock_cost"),
        )

    # Catalogues as they would come from files

    @cached_property
    def raw_stores(self) -> DataFrame:
        c = F.col
        nation = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "inner"
        )
        return (
            self.table("supplier")
            .join(nation, c("s_nationkey") == c("n_nationkey"), "inner")
            .select(
                "s_suppkey",
                (c("s_suppkey") % STORES).cast("int").alias("store"),
                c("s_name").alias("store_name"),
                c("r_name").alias("format"),
                c("n_name").alias("region"),
                F.concat(F.lit("Z"), (c("s_nationkey") % 4).cast("string")).alias("zone"),
                F.when(c("s_acctbal") < 0, "EXPRESS").otherwise("NORMAL").alias("store_type"),
            )
        )

    @cached_property
    def raw_skus(self) -> DataFrame:
        c = F.col
        status = F.when(c("p_size") == 49, "P").when(c("p_size") == 48, "AT").otherwise("A")
        return self.table("part").select(
            c("p_partkey").alias("sku"),
            _tenth(c("p_partkey")).alias("upc"),
            c("p_name").alias("description"),
            status.alias("status"),
            c("p_type").alias("dept"),
            F.concat(F.lit("Dept "), c("p_type")).alias("dept_name"),
            c("p_brand").alias("subdept"),
            F.concat(F.lit("Sub "), c("p_brand")).alias("subdept_name"),
            (c("p_size") % 5).alias("class_id"),
            c("p_size").alias("subclass_id"),
        )

    @cached_property
    def raw_store_deciles(self) -> DataFrame:
        return self.lines.filter(F.col("l_returnflag") == "R").select(
            "sku",
            "store",
            (cents(F.col("l_discount")) + 1).cast("int").alias("decile"),
            F.col("day").alias("valid_from"),
            F.date_add("day", 30).alias("valid_to"),
        )

    @cached_property
    def raw_national_deciles(self) -> DataFrame:
        number = (F.col("l_quantity").cast("int") % 10 + 1).cast("string")
        return self.lines.select("sku", "upc", F.concat(F.lit("NAC D"), number).alias("decile"))

    @cached_property
    def raw_taxes(self) -> DataFrame:
        return self.table("part").filter(F.col("p_size") != 13).select(
            F.col("p_partkey").alias("sku"),
            F.when(F.col("p_size") % 2 == 0, 160.0).alias("iva"),
            F.when(F.col("p_size") % 5 == 0, 80.0).alias("ieps"),
        )

    @cached_property
    def raw_matrix(self) -> DataFrame:
        """Every department in every store with three ranked competitor stores.

        Listed once per article size; size 50 names no competitor store.
        """
        c = F.col
        ranked = (
            self.table("part")
            .select(c("p_type").alias("dept"), c("p_brand").alias("subdept"), "p_size")
            .distinct()
            .withColumn("store", F.explode(F.sequence(F.lit(0), F.lit(STORES - 1))))
            .withColumn("priority", F.explode(F.sequence(F.lit(1), F.lit(3))))
            .withColumn("comp_store", (c("store") + c("priority")) % STORES)
        )
        chain = F.element_at(
            F.array(*(F.lit(n) for n in (*schemas.CLEARANCE_CHAINS, "OTHER"))), c("comp_store") % 3 + 1
        )
        return ranked.select(
            "store",
            "priority",
            "dept",
            "subdept",
            F.when(c("p_size") != 50, c("comp_store")).alias("comp_store"),
            F.concat(F.lit("S"), (c("comp_store") % 3).cast("string")).alias("comp_source"),
            chain.alias("comp_chain"),
        )

    @cached_property
    def raw_promo_limits(self) -> DataFrame:
        return self.table("part").filter(F.col("p_type") == "PROMO").select(
            F.col("p_type").alias("dept"), F.col("p_brand").alias("subdept"), F.lit(10).alias("promo_percent")
        )

    @cached_property
    def raw_groups(self) -> DataFrame:
        group = F.floor(F.col("p_partkey") / 50).cast("long")
        return self.table("part").select(
            F.col("p_partkey").alias("sku"), F.when(F.col("p_size") % 7 != 0, group).alias("price_group")
        )

    @cached_property
    def raw_exceptions(self) -> DataFrame:
        return self.table("part").filter((F.col("p_size") == 50) & (F.col("p_type") == "SMALL")).select(
            F.col("p_partkey").alias("sku"), F.lit("E").alias("exception")
        )

    @cached_property
    def lazy_cats(self) -> dims.Catalogues:
        skus = dims.skus(self.raw_skus)
        return dims.Catalogues(
            stores=dims.stores(self.raw_stores, ["s_suppkey"]),
            skus=skus,
            store_deciles=dims.store_deciles(self.raw_store_deciles),
            national_deciles=dims.national_deciles(self.raw_national_deciles),
            taxes=dims.taxes(self.raw_taxes),
            matrix=dims.competition_matrix(self.raw_matrix),
            promo_limits=dims.promo_limits(self.raw_promo_limits),
            margins=dims.empty_margins(skus),
            price_groups=dims.price_groups(self.raw_groups),
            exceptions=dims.exceptions(self.raw_exceptions),
        )

    # Stages of the run, each written once per session

    def staged(self, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            with lasting():
                _STAGED[key] = settled(self.spark, name, build)
        return _STAGED[key]

    def kept(self, name: str, build) -> DataFrame:
        """What ``build`` makes of stage tables of its own, which stay."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            with lasting():
                _STAGED[key] = build()
        return _STAGED[key]

    @cached_property
    def prices(self) -> DataFrame:
        return self.staged("prices", lambda: self.lazy_prices)

    @cached_property
    def sales(self) -> DataFrame:
        """Sales of every week."""
        return self.staged("sales", lambda: self.lazy_sales)

    @cached_property
    def total_sales(self) -> DataFrame:
        """Sales of all weeks together, as the sales of the run."""
        return self.staged(
            "total_sales", lambda: self._sales_by("sku", "store").withColumn("period", F.lit(self.run_period))
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.staged("inventory", lambda: self.lazy_inventory)

    @cached_property
    def snapshot(self) -> DataFrame:
        """The stock on the Friday of the run: one row per article and store, all dated that day."""
        day = midweek_date(self.run_period)
        return self.staged("snapshot", lambda: asof_inventory(self.inventory, day).withColumn("stock_date", F.lit(day)))

    @cached_property
    def newest_stock(self) -> DataFrame:
        """The newest stock on record: one row per article and store, also those counted after the Friday of the run."""
        return self.staged("newest_stock", lambda: newest_inventory(self.inventory))

    @cached_property
    def cats(self) -> _StagedCatalogues:
        return _StagedCatalogues(self)

    def fresh_stats(self) -> CompetitorStats:
        with lasting():
            base = stage(look_back_prices(self.prices, self.cats.matrix, self.run_period, 0, self.look_back), "base_prices")
        return competitor_stats(base, self.run_period)

    @cached_property
    def stats(self) -> CompetitorStats:
        names = [f.name for f in fields(CompetitorStats)]
        made = _Once(self.fresh_stats)
        return CompetitorStats(**{n: self.staged(n, lambda n=n: getattr(made.value, n)) for n in names})

    def lazy_fact(self, sales: DataFrame | None = None, **options) -> DataFrame:
        return fact_table(
            self.total_sales if sales is None else sales,
            self.prices,
            self.inventory,
            self.stats,
            self.cats,
            self.run_period,
            rebase=False,
            asof=midweek_date(self.run_period),
            **options,
        )

    @cached_property
    def fact(self) -> DataFrame:
        return self.kept("fact", self.lazy_fact)

    def fresh_weekly_stats(self) -> CompetitorStats:
        return competitor_stats_by_week(self.prices, self.cats.matrix, stage(run_periods(self.sales), "runs"))

    def lazy_weekly_fact(self) -> DataFrame:
        """The fact table of every week on record, each with its own look-back and as-of day."""
        return weekly_runs(self.sales, self.prices, self.inventory, self.cats)

    @cached_property
    def weekly_fact(self) -> DataFrame:
        return self.kept("weekly_fact", self.lazy_weekly_fact)

    @cached_property
    def suggested(self) -> DataFrame:
        return self.staged("suggested", lambda: suggested_prices(self.fact, self.cats).rows)

    @cached_property
    def suggested_with_modes(self) -> DataFrame:
        return self.staged(
            "suggested_with_modes",
            lambda: suggested_prices(self.fact, self.cats, ignore_national_mode=False).rows,
        )

    def lazy_impact(self, stock: DataFrame | None = None, **options) -> PriceImpact:
        prices = self.suggested if options.get("ignore_national_mode", True) else self.suggested_with_modes
        return price_impact(prices, self.snapshot if stock is None else stock, self.total_sales, self.cats, **options)

    @cached_property
    def impact(self) -> PriceImpact:
        lazy = self.lazy_impact(how="full", ignore_national_mode=False)
        return PriceImpact(self.staged("impact", lambda: lazy.rows), lazy.group_exceptions)

    @cached_property
    def newest_impact(self) -> DataFrame:
        """The impact on the newest stock of all pairs."""
        return self.staged(
            "newest_impact",
            lambda: self.lazy_impact(self.newest_stock, how="full", ignore_national_mode=False).rows,
        )

    @cached_property
    def default_impact(self) -> DataFrame:
        return self.staged("default_impact", lambda: self.lazy_impact().rows)
