"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import feeds
from registry.roles import Roles
from shelfwise import schemas
from shelfwise.functions import prices as px
from shelfwise.functions import weeks as wk
from shelfwise.operators import groups, matching, pricestats, ranking, rollups
from shelfwise.plans import competitor_stats as comp_plan
from shelfwise.plans import descriptive as desc_plan
from shelfwise.plans import fact_table as fact_plan
from shelfwise.plans import price_impact as impact_plan
from shelfwise.plans import weekly_runs as weekly_plan
from shelfwise.plans.suggested_prices import single_prices, suggested_prices
from shelfwise.plans.weekly import run_week
from shelfwise.session import settled, shared_dir
from shelfwise.sources import delimited, tables

Query = Callable[[Roles], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, four: str = "", two: str = "") -> DataFrame:
    """Sums and averages depend on the order of addition in their last bits; cut those off."""
    cut = {}
    for names, factor in ((four, 1e4), (two, 1e2)):
        for name in names.split():
            cut[name] = (F.floor(F.col(name) * factor + 0.5 + 1e-5) / factor).cast("double")
    return df.withColumns(cut)


def _folder(r: Roles, name: str) -> str:
    return f"{shared_dir(r.spark)}/{name}-{uuid.uuid4().hex}"


def _weeks(df: DataFrame) -> list[int]:
    return [row.period for row in df.select("period").distinct().orderBy("period").collect()]


# Sources and sinks


@query
def scan_delimited(r: Roles) -> DataFrame:
    path = _folder(r, "delimited")
    headings = {"sku": "Articulo", "upc": "EAN_UPC", "description": "Descripcion", "status": "Estatus"}
    r.raw_skus.select(*headings).withColumnsRenamed(headings).write.csv(path, sep="|", header=True, nullValue="NA")
    wanted = T.StructType([f for f in schemas.SKUS if f.name in headings])
    return delimited.read_delimited(r.spark, path, wanted)


@query
def weekly_sales(r: Roles) -> DataFrame:
    """Sales of all weeks, from a file per week."""
    root = _folder(r, "sales_files")
    feeds.write_sales(r.sales, root)
    return delimited.read_sales(r.spark, root, _weeks(r.sales)).select(*r.sales.columns)


@query
def competitor_prices(r: Roles) -> DataFrame:
    """Prices of all weeks, from a file per feed and week; each feed heads its columns differently."""
    root = _folder(r, "price_files")
    feeds.write_prices(r.prices, root)
    return delimited.read_competitor_prices(r.spark, root, _weeks(r.prices)).select(*r.prices.columns)


@query
def inventory_read(r: Roles) -> DataFrame:
    """One inventory snapshot whose dates are missing, plain, or written out."""
    root = _folder(r, "stock_files")
    feeds.write_stock(r.inventory, root, "Inven_02Nov01.csv")
    rows = delimited.read_inventory(r.spark, root, "Inven_02Nov01.csv", date(2001, 11, 2))
    return rows.withColumn("stock_date", F.col("stock_date").cast("string"))


@query
def competitor_prices_multiweek(r: Roles) -> DataFrame:
    return comp_plan.look_back(r.prices, r.run_period, 0, 52)


@query
def union_periods(r: Roles) -> DataFrame:
    """Weekly tables saved year by year, put together again."""
    path = _folder(r, "years")
    years = sorted({week // 100 for week in _weeks(r.sales)})
    for year in years:
        tables.save_table(r.sales.filter(F.floor(F.col("period") / 100) == year), f"{path}/{year}")
    return tables.union_saved(r.spark, [f"{path}/{year}" for year in years])


@query
def feed_inventory(r: Roles) -> DataFrame:
    """Source and week of every weekly feed file, from their names."""
    root = _folder(r, "price_files")
    feeds.write_prices(r.prices, root)
    return delimited.feed_inventory(r.spark, f"{root}/preciosCompetencia")


@query
def latest_snapshot(r: Roles) -> DataFrame:
    """Newest inventory up to a day, the day being read from file names with Spanish months."""
    name = F.date_format("stock_date", "ddMMMyy")
    for spanish, english in delimited.MONTHS.items():
        name = F.replace(name, F.lit(english), F.lit(spanish))
    files = r.inventory.withColumn("file", F.concat(F.lit("Inven_"), name, F.lit(".csv")))
    dated = files.withColumn("snapshot_date", delimited.snapshot_day(F.col("file")))
    return matching.latest_snapshot(dated, date(2000, 6, 15)).select(
        "file", F.col("snapshot_date").cast("string").alias("snapshot_date"), "sku", "store", "stock_units"
    )


@query
def save_load_roundtrip(r: Roles) -> DataFrame:
    path = _folder(r, "roundtrip")
    tables.save_delimited(r.sales, path)
    return tables.load_delimited(r.spark, path)


@query
def split_export(r: Roles) -> DataFrame:
    path = _folder(r, "split")
    tables.split_export(r.sales_with_hierarchy, path, ["dept", "subdept"])
    return tables.load_table(r.spark, path).select(*r.sales_with_hierarchy.columns)


@query
def export_report(r: Roles) -> DataFrame:
    path = _folder(r, "report")
    tables.export_report(r.sales, path, ["store", "sku", "period"])
    kinds = {f.name: f.dataType for f in r.sales.schema}
    back = r.spark.read.csv(path, sep="|", header=True)
    return back.select(*(F.col(c).cast(kinds[c]).alias(c) for c in r.sales.columns))


@query
def competitor_store_catalogue(r: Roles) -> DataFrame:
    return delimited.competitor_store_catalogue(r.prices, "S1")


# Catalogues


@query
def dim_stores(r: Roles) -> DataFrame:
    return r.lazy_cats.stores


@query
def dim_skus(r: Roles) -> DataFrame:
    return r.lazy_cats.skus


@query
def dim_store_deciles_latest(r: Roles) -> DataFrame:
    return r.lazy_cats.store_deciles


@query
def dim_national_deciles(r: Roles) -> DataFrame:
    return r.lazy_cats.national_deciles


@query
def dim_taxes(r: Roles) -> DataFrame:
    return r.lazy_cats.taxes


@query
def dim_competition_matrix(r: Roles) -> DataFrame:
    return r.lazy_cats.matrix


@query
def dim_promo_limits(r: Roles) -> DataFrame:
    return r.lazy_cats.promo_limits


@query
def dim_price_groups(r: Roles) -> DataFrame:
    return r.lazy_cats.price_groups


@query
def dim_exceptions(r: Roles) -> DataFrame:
    return r.lazy_cats.exceptions


# Projections and predicates


@query
def restricted_extract(r: Roles) -> DataFrame:
    """Sales of the discontinued articles in the stores of one format."""
    discontinued = r.cats.skus.filter(F.col("status") == "AT")
    return rollups.restricted_extract(r.sales, discontinued, r.cats.stores.filter(F.col("format") == "ASIA"))


@query
def store_scope_filter(r: Roles) -> DataFrame:
    """Lines per store id in scope; ids are spread over 0-999."""
    store = (F.col("l_suppkey") * 7 % 1000).cast("int")
    return (
        r.lines.select(store.alias("store"))
        .filter(impact_plan.in_store_scope(F.col("store")))
        .groupBy("store")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def exception_split(r: Roles) -> DataFrame:
    regular, exceptional = groups.split_exceptions(r.suggested)
    parts = [
        part.select("sku", "store", "suggested_price", F.lit(name).alias("part"))
        for part, name in ((regular, "regular"), (exceptional, "exceptional"))
    ]
    return parts[0].unionByName(parts[1])


@query
def fact_metrics(r: Roles) -> DataFrame:
    names = """sku store avg_price avg_price_gross central_price_gross amount_gross central_sales
        central_sales_gross comp_sales comp_sales_now margin_gross central_margin_gross comp_margin
        comp_margin_now cup cupc simulated_check_impact real_check_impact cuic cut comp_now_minus_sales
        comp_minus_hist_median clearance comp_clearance comp_clearance_now promo comp_promo comp_promo_now
        comp_promo_recent target_margin""".split()
    return r.fact.select(*names, "priority", "comp_store")


@query
def fallback_cascade(r: Roles) -> DataFrame:
    rows = r.suggested_with_modes.withColumns(
        {
            "suggested_price": F.when(F.col("suggested_source") == schemas.SPOT, F.col("suggested_price")),
            "group_price": F.when(F.col("group_priority") == 1, F.col("group_price")),
        }
    )
    return impact_plan.fall_back(rows, ignore_national_mode=False).select(
        "sku", "store", "suggested_price", "suggested_source"
    )


# Joins


@query
def join_inner_sales_stores(r: Roles) -> DataFrame:
    return r.sales.join(r.cats.stores, "store", "inner").select(
        "period", "sku", "store", "format", "region", "units", "amount"
    )


@query
def join_left_prices(r: Roles) -> DataFrame:
    """Sales next to the competitor price of the same week, UPC and store number."""
    prices = r.prices.select("period", "upc", F.col("comp_store").alias("store"), "comp_price")
    return r.sales_with_hierarchy.select("period", "sku", "upc", "store", "amount").join(
        prices, ["period", "upc", "store"], "left"
    )


@query
def join_full_inventory_sales(r: Roles) -> DataFrame:
    stock = r.inventory.groupBy("sku", "store").agg(F.max("stock_date").cast("string").alias("stock_date"))
    return stock.join(r.total_sales.select("sku", "store", "units", "amount"), ["sku", "store"], "full")


@query
def latest_price_per_store(r: Roles) -> DataFrame:
    return matching.latest_price_per_store(r.prices)


@query
def matrix_expand(r: Roles) -> DataFrame:
    lines = r.total_sales.join(r.cats.skus.select("sku", "upc", "dept", "subdept"), "sku", "inner")
    return matching.matrix_expand(lines, r.cats.matrix).select(
        "sku", "upc", "store", "dept", "subdept", "priority", "comp_store", "comp_source", "amount"
    )


def _hierarchy(r: Roles) -> DataFrame:
    return r.cats.skus.select("sku", "upc", *fact_plan.HIERARCHY)


@query
def priority_pick(r: Roles) -> DataFrame:
    """Best competitor store of every article and store, with its latest price moved to an ending."""
    lines = fact_plan.sales_lines(r.total_sales, _hierarchy(r))
    then = fact_plan.week_prices(r.prices, wk.week_before(r.run_period, 2), "comp_price")
    now = fact_plan.week_prices(r.prices, r.run_period, "comp_price_now")
    recent = matching.latest_price_per_store(comp_plan.look_back(r.prices, r.run_period, 0, r.look_back))
    picked = matching.priority_pick(lines, r.cats.matrix, then, now, recent).join(
        recent, matching.OBSERVATION, "left"
    )
    return (
        lines.select("sku", "upc", "store", "dept", "subdept")
        .join(picked, ["store", "upc", "dept", "subdept"], "inner")
        .select(
            "sku",
            "upc",
            "store",
            "comp_store",
            "comp_source",
            "priority",
            matching.base_priority(F.col("priority")).alias("base_priority"),
            px.ending_price(F.col("comp_price_recent")).alias("price"),
        )
    )


@query
def asof_inventory(r: Roles) -> DataFrame:
    rows = matching.asof_inventory(r.inventory, wk.midweek_date(r.run_period))
    return rows.withColumn("stock_date", F.col("stock_date").cast("string"))


@query
def store_membership(r: Roles) -> DataFrame:
    """Store numbers with sales against the numbers of a customer list kept as text."""
    left = r.lines.filter(F.col("l_returnflag") == "R").select(F.col("l_suppkey").alias("store"))
    right = r.table("customer").select((F.col("c_custkey") * 3).cast("string").alias("store"))
    return matching.store_membership(left, right)


@query
def join_retention_funnel(r: Roles) -> DataFrame:
    then = fact_plan.week_prices(r.prices, wk.week_before(r.run_period, 2), "comp_price")
    now = fact_plan.week_prices(r.prices, r.run_period, "comp_price")
    return matching.join_retention(r.sales_with_hierarchy, r.cats.matrix, now, then)


@query
def contingency_fill(r: Roles) -> DataFrame:
    """Stocked pairs with the prices of the article or its group where they have none."""
    pairs = r.inventory.select("sku", "store").distinct().join(r.cats.price_groups, "sku", "left")
    rows = pairs.join(r.suggested.drop("price_group"), ["sku", "store"], "left")
    return impact_plan.fill_contingency(rows, impact_plan.contingency(r.suggested)).select(
        "sku", "store", "price_group", "national_median", "national_mode", "group_price", "group_sku",
        "group_priority", "group_comp_store", "group_median", "group_mode",
    )


def _group_rows(r: Roles) -> DataFrame:
    return (
        single_prices(r.fact)
        .join(r.cats.price_groups, "sku", "left")
        .join(r.cats.promo_limits, ["dept", "subdept"], "left")
        .fillna(px.DEFAULT_PROMO_PERCENT, ["promo_percent"])
    )


@query
def group_price(r: Roles) -> DataFrame:
    return groups.group_prices(_group_rows(r)).select(
        "store", "price_group", "group_store_median", "group_price"
    )


@query
def group_price_top_priority(r: Roles) -> DataFrame:
    return groups.group_prices(_group_rows(r), pool="top_priority").select(
        "store", "price_group", "group_store_median", "group_price"
    )


@query
def group_price_provenance(r: Roles) -> DataFrame:
    return groups.group_prices(_group_rows(r)).drop("group_store_median")


@query
def store_name_reconcile(r: Roles) -> DataFrame:
    """Names of ranked competitor stores against the names found in two price feeds."""

    def named(df: DataFrame) -> DataFrame:
        name = F.concat("comp_source", F.lit("-"), F.col("comp_store").cast("string"))
        return df.withColumn("comp_name", name)

    feeds = [named(r.prices.filter(F.col("comp_source") == s)) for s in ("S0", "S1")]
    return matching.reconcile_names(named(r.cats.matrix), feeds, "comp_name")


@query
def store_name_reconcile_all_feeds(r: Roles) -> DataFrame:
    """Names of ranked competitor stores against the names found in any price feed."""
    named = lambda df: df.withColumn("comp_name", F.concat("comp_source", F.lit("-"), F.col("comp_store").cast("string")))
    return matching.reconcile_names(named(r.cats.matrix), [named(r.prices)], "comp_name")


@query
def inventory_universe(r: Roles) -> DataFrame:
    return matching.inventory_universe(r.inventory, r.total_sales.select("sku", "store", "units", "amount"))


# Aggregations


@query
def national_price_stats(r: Roles) -> DataFrame:
    return rounded(comp_plan.national_price_stats(r.prices), "market_avg market_std")


@query
def national_price_stats_two_periods(r: Roles) -> DataFrame:
    return rounded(
        comp_plan.national_two_periods(r.prices), "market_avg market_std market_now_avg market_now_std"
    )


@query
def store_price_history(r: Roles) -> DataFrame:
    return rounded(comp_plan.store_price_history(r.prices), "hist_avg hist_std")


@query
def rounded_mode(r: Roles) -> DataFrame:
    return pricestats.price_stats(r.prices, ["upc"], "comp_price", "price", ("mode", "mode_freq"))


@query
def observed_median(r: Roles) -> DataFrame:
    return pricestats.price_stats(r.prices, ["upc"], "comp_price", "price", ("median",))


@query
def recent_national_stats(r: Roles) -> DataFrame:
    return rounded(comp_plan.recent_national_stats(r.prices), "recent_market_avg")


@query
def sales_price_stats_by_format(r: Roles) -> DataFrame:
    lines = fact_plan.sales_lines(r.sales, _hierarchy(r))
    return rounded(
        fact_plan.sales_price_stats_by_format(lines, r.cats.stores), "format_price_avg format_price_std"
    )


@query
def sales_sum_weeks(r: Roles) -> DataFrame:
    sums = rollups.sales_sum_weeks(r.sales, r.cats.skus, r.run_period, r.look_back)
    return rounded(sums, "total_amount")


@query
def competitor_upcs(r: Roles) -> DataFrame:
    return comp_plan.competitor_upcs(r.prices, r.run_period, r.look_back)


@query
def group_exceptions(r: Roles) -> DataFrame:
    return groups.group_exceptions(r.cats.exceptions, r.cats.price_groups)


@query
def coverage_by_subdept(r: Roles) -> DataFrame:
    return rounded(
        impact_plan.coverage_by_subdept(r.impact.rows), two="impact_vs_central impact_vs_average"
    )


@query
def coverage_by_subdept_both(r: Roles) -> DataFrame:
    return rounded(
        impact_plan.coverage_by_subdept(r.default_impact, require_both=True),
        two="impact_vs_central impact_vs_average",
    )


@query
def regulated_counts(r: Roles) -> DataFrame:
    return impact_plan.regulated_counts(r.newest_impact)


@query
def impact_by_sku(r: Roles) -> DataFrame:
    return rounded(impact_plan.impact_by_sku(r.impact.rows, r.cats), two="impact_vs_central impact_vs_average")


@query
def impact_by_store(r: Roles) -> DataFrame:
    return rounded(impact_plan.impact_by_store(r.newest_impact, r.cats), two="impact_vs_central impact_vs_average")


@query
def suggestion_counts(r: Roles) -> DataFrame:
    return impact_plan.suggestion_counts(r.impact.rows)


@query
def null_suggestion_skus(r: Roles) -> DataFrame:
    return impact_plan.null_suggestion_skus(r.lazy_impact(), r.cats)


@query
def promo_fallback_report(r: Roles) -> DataFrame:
    return impact_plan.promo_fallback_report(r.impact.rows).select(
        "sku", "store", "suggested_price", "suggested_source", "spot_price", "national_mode"
    )


@query
def desc_counts(r: Roles) -> DataFrame:
    return desc_plan.weekly_counts(r.sales_with_hierarchy)


@query
def desc_stores(r: Roles) -> DataFrame:
    taxed = desc_plan.gross_sales(r.sales_with_hierarchy, r.cats.taxes)
    return rounded(desc_plan.store_totals(taxed, r.cats.stores), two="amount amount_gross")


@query
def desc_items(r: Roles) -> DataFrame:
    taxed = desc_plan.gross_sales(r.sales_with_hierarchy, r.cats.taxes)
    return rounded(desc_plan.item_stats(taxed), "price_avg price_std", "amount amount_gross")


@query
def desc_minmax_stores(r: Roles) -> DataFrame:
    return desc_plan.extreme_price_stores(desc_plan.gross_sales(r.sales_with_hierarchy, r.cats.taxes))


@query
def rollup_nine_keys(r: Roles) -> DataFrame:
    sums = "sum_amount sum_amount_gross sum_comp_sales sum_comp_sales_now sum_comp_now_minus_sales"
    return rounded(rollups.rollup_nine_keys(r.weekly_fact), two=sums)


@query
def rollup_flags(r: Roles) -> DataFrame:
    return rounded(rollups.rollup_flags(rollups.rollup_nine_keys(r.weekly_fact)), two="difference")


@query
def price_change_distribution(r: Roles) -> DataFrame:
    out = rollups.price_change_distribution(r.weekly_fact, ["period", "dept", "subdept"])
    return rounded(out, "change_avg")


@query
def price_change_by_dept(r: Roles) -> DataFrame:
    out = rollups.price_change_distribution(r.weekly_fact, ["dept"])
    return rounded(out, "change_avg")


@query
def store_period_coverage(r: Roles) -> DataFrame:
    return rollups.store_period_coverage(r.sales, r.cats.stores)


# Ordered work


def _totals(r: Roles) -> DataFrame:
    return rollups.sales_sum_weeks(r.sales, r.cats.skus, r.run_period, r.look_back).filter(
        F.col("total_amount") > 0
    )


def _shares(r: Roles, group: list[str]) -> DataFrame:
    by_amount = ranking.cumulative_share(_totals(r), group, "total_amount", ["sku", "store"], "amount_")
    keep = [*dict.fromkeys(["sku", "store", *group])]
    # amounts lie on a grid of 1e-4, so four digits never cut at a tie
    columns = ["amount_total", "amount_running", "amount_share"]
    return rounded(by_amount.select(*keep, *columns), " ".join(columns))


@query
def cumulative_share(r: Roles) -> DataFrame:
    return _shares(r, ["store"])


@query
def cumulative_share_subdept(r: Roles) -> DataFrame:
    return _shares(r, ["store", "dept", "subdept"])


@query
def cumulative_share_units(r: Roles) -> DataFrame:
    return _unit_shares(r, ["store", "dept", "subdept", "class_id"])


@query
def cumulative_share_class(r: Roles) -> DataFrame:
    return _shares(r, ["store", "dept", "subdept", "class_id"])


def _unit_shares(r: Roles, group: list[str]) -> DataFrame:
    out = ranking.cumulative_share(_totals(r), group, "total_units", ["sku", "store"], "units_")
    return rounded(out.select("sku", *group, "units_total", "units_running", "units_share"), "units_share")


@query
def cumulative_share_units_store(r: Roles) -> DataFrame:
    return _unit_shares(r, ["store"])


@query
def cumulative_share_units_subdept(r: Roles) -> DataFrame:
    return _unit_shares(r, ["store", "dept", "subdept"])


@query
def deciles_by_level(r: Roles) -> DataFrame:
    levels = ["dept", "subdept", "class_id", "subclass_id"]
    out = ranking.deciles_by_level(_totals(r), levels, ["total_amount", "total_units"])
    return rounded(out, "total_amount")


@query
def top_skus_per_decile(r: Roles) -> DataFrame:
    return rounded(rollups.top_skus_per_decile(r.fact), two="sales")


@query
def top_stores(r: Roles) -> DataFrame:
    return rounded(rollups.top_stores(r.fact), two="sales")


@query
def store_sales_by_chain(r: Roles) -> DataFrame:
    return rounded(rollups.store_sales(r.fact), two="sales")


# Scalar expressions


@query
def price_rounding(r: Roles) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        px.ending_price(price).alias("unit_price"),
        px.ending_price(price / 100).alias("low_price"),
    )


@query
def ending_flag(r: Roles) -> DataFrame:
    return r.prices.withColumn("is_clearance", px.clearance_ending(F.col("comp_price")).cast("int"))


@query
def yearweek_shift(r: Roles) -> DataFrame:
    week = F.col("period")
    return r.lines.select("period").distinct().select(
        "period",
        *(wk.shift_week(week, n).alias(f"back_{n}") for n in (1, 2, 6, 12, 52)),
        wk.shift_week(week, -1).alias("next_week"),
    )


@query
def yearweek_midweek(r: Roles) -> DataFrame:
    return r.lines.select("period").distinct().select(
        "period", wk.midweek_day(F.col("period")).cast("string").alias("midweek")
    )


@query
def gross_price(r: Roles) -> DataFrame:
    taxed = r.sales.join(r.cats.taxes, "sku", "inner")
    return taxed.select(
        "period", "sku", "store", px.gross(F.col("amount"), F.col("iva"), F.col("ieps")).alias("amount_gross")
    )


@query
def promo_flag(r: Roles) -> DataFrame:
    """Every competitor price against the median of its UPC."""
    median = pricestats.price_stats(r.prices, ["upc"], "comp_price", "upc", ("median",))
    price, reference = F.col("comp_price"), F.col("upc_median")
    return r.prices.join(median, "upc", "left").select(
        "period",
        "upc",
        "comp_store",
        px.drop_flag(price, reference, 20).alias("promo"),
        px.clearance_flag(price, reference).alias("clearance"),
    )


# Pipelines


@query
def competitor_stats(r: Roles) -> DataFrame:
    """Store history and latest price with the national statistics of its UPC."""
    s = r.fresh_stats()
    out = (
        s.store_history.join(s.recent_store, matching.OBSERVATION, "left")
        .join(s.national, "upc", "left")
        .join(s.recent_national, "upc", "left")
    )
    return rounded(
        out, "hist_avg hist_std market_avg market_std market_now_avg market_now_std recent_market_avg"
    )


_FACT_NOISE = """hist_avg hist_std market_avg market_std market_now_avg market_now_std recent_market_avg
    format_price_avg format_price_std"""


@query
def fact_table(r: Roles) -> DataFrame:
    return rounded(r.lazy_fact(), _FACT_NOISE)


@query
def weekly_competitor_stats(r: Roles) -> DataFrame:
    """The same for every week, each with its own look-back."""

    def joined() -> DataFrame:
        s = r.fresh_weekly_stats()
        out = (
            s.store_history.join(s.recent_store, ["period", *matching.OBSERVATION], "left")
            .join(s.national, ["period", "upc"], "left")
            .join(s.recent_national, ["period", "upc"], "left")
        )
        return rounded(
            out, "hist_avg hist_std market_avg market_std market_now_avg market_now_std recent_market_avg"
        )

    return settled(r.spark, "weekly_stats", joined, together=True)


@query
def asof_inventory_by_week(r: Roles) -> DataFrame:
    """Stock of every article, store and week of sales as of the Friday of the week."""
    rows = weekly_plan.asof_inventory_by_week(r.inventory, r.sales)
    return rows.withColumn("stock_date", F.col("stock_date").cast("string"))


@query
def weekly_runs(r: Roles) -> DataFrame:
    """The fact tables of all weeks, run as one job."""
    return rounded(r.lazy_weekly_fact(), _FACT_NOISE)


@query
def weekly_reruns(r: Roles) -> DataFrame:
    """Weekly tables saved by week, two of them run again, and read back as one."""
    path = _folder(r, "weeks")
    saved = r.weekly_fact.select("period", "sku", "store", "comp_store", "priority", "units", "comp_price")
    tables.save_periods(saved.withColumn("units", F.when(F.col("period") % 100 < 27, F.col("units")).otherwise(0.0)), path)
    tables.save_periods(saved.filter(F.col("period") % 100 >= 27), path)
    return tables.union_saved(r.spark, [path]).select(*saved.columns)


@query
def fact_table_inventory(r: Roles) -> DataFrame:
    """Lines for every stocked pair, without filling missing prices by modes."""
    return rounded(r.lazy_fact(universe=r.inventory, fill_with_mode=False), _FACT_NOISE)


@query
def suggested_prices_default(r: Roles) -> DataFrame:
    return suggested_prices(r.fact, r.cats).rows


@query
def suggested_prices_national_mode(r: Roles) -> DataFrame:
    return suggested_prices(r.fact, r.cats, ignore_national_mode=False).rows


@query
def suggested_prices_clearance_endings(r: Roles) -> DataFrame:
    return suggested_prices(r.fact, r.cats, flag_clearance_endings=True).rows


@query
def suggested_prices_all_priorities(r: Roles) -> DataFrame:
    return suggested_prices(r.fact, r.cats, top_priority_only=False).rows


@query
def suggested_prices_keep_low(r: Roles) -> DataFrame:
    return suggested_prices(r.fact, r.cats, drop_low_prices=False).rows


@query
def price_impact(r: Roles) -> DataFrame:
    return r.lazy_impact(r.newest_stock).rows


@query
def price_impact_full(r: Roles) -> DataFrame:
    return r.lazy_impact(r.newest_stock, how="full", ignore_national_mode=False).rows


@query
def weekly_chain(r: Roles) -> DataFrame:
    """The whole run of a week, every stage written and read back: its impact."""
    out = _folder(r, "run")
    run_week(
        r.spark,
        period=r.run_period,
        sales=r.total_sales,
        impact_sales=r.total_sales,
        prices=r.prices,
        inventory=r.inventory,
        snapshot=r.snapshot,
        cats=r.lazy_cats,
        out=out,
        look_back=(0, r.look_back),
        fact_options={"rebase": False},
    )
    return tables.load_table(r.spark, f"{out}/impact_{r.run_period}")


@query
def central_price_asof(r: Roles) -> DataFrame:
    return matching.central_price_asof(r.inventory, wk.midweek_date(r.run_period))


@query
def central_price_snapshot(r: Roles) -> DataFrame:
    return matching.central_price_snapshot(r.snapshot)


@query
def group_min_price(r: Roles) -> DataFrame:
    return groups.group_min_prices(r.fact, r.cats.price_groups)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn: Query):
        return lambda spark, sf_dir: fn(Roles(spark, sf_dir))

    names = {"suggested_prices_default": "suggested_prices"}
    return {names.get(name, name): bound(fn) for name, fn in QUERIES.items()}
