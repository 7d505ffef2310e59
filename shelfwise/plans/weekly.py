"""The weekly run: every stage written once, the next one reading it back."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.dims import Catalogues
from shelfwise.plans import price_impact as impact_plan
from shelfwise.plans.competitor_stats import CompetitorStats, competitor_stats, look_back_prices
from shelfwise.plans.fact_table import fact_table
from shelfwise.plans.suggested_prices import SuggestedPrices, suggested_prices
from shelfwise.session import unstage
from shelfwise.sources.tables import load_table, save_table


def _kept(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    save_table(df, path)
    return load_table(spark, path)


def run_competitor_stats(spark, prices, matrix, period, out, first=0, last=6) -> CompetitorStats:
    base = look_back_prices(prices, matrix, period, first, last)
    stats = competitor_stats(_kept(spark, base, f"{out}/base_prices_{period}"), period)
    return CompetitorStats(
        **{f.name: _kept(spark, getattr(stats, f.name), f"{out}/{f.name}_{period}") for f in fields(stats)}
    )


def run_fact_table(spark, sales, prices, inventory, stats, cats, period, out, **options) -> DataFrame:
    fact = fact_table(sales, prices, inventory, stats, cats, period, **options)
    kept = _kept(spark, fact, f"{out}/fact_{period}")
    unstage(fact)
    return kept


def kept_catalogues(spark, cats: Catalogues, out) -> Catalogues:
    """The catalogues, each read and reduced once and written next to the results."""
    return Catalogues(**{f.name: _kept(spark, getattr(cats, f.name), f"{out}/catalogue_{f.name}") for f in fields(Catalogues)})


def run_suggested_prices(spark, fact, cats, period, out, **options) -> SuggestedPrices:
    """Regular and exceptional rows are two folders of one table, written in one job."""
    prices = suggested_prices(fact, cats, **options)
    auxiliary = _kept(spark, prices.auxiliary, f"{out}/prices_auxiliary_{period}")
    regular = F.col("exception").isNull() & F.col("group_exception").isNull()
    part = F.when(regular, "regular").otherwise("exceptional")
    save_table(prices.rows.withColumn("part", part), f"{out}/prices_{period}", ["part"])
    rows = load_table(spark, f"{out}/prices_{period}").drop("part")
    return SuggestedPrices(auxiliary=auxiliary, rows=rows)


def run_price_impact(spark, prices, snapshot, sales, cats, period, out, **options) -> impact_plan.PriceImpact:
    impact = impact_plan.price_impact(prices, snapshot, sales, cats, **options)
    rows = _kept(spark, impact.rows, f"{out}/impact_{period}")
    impact = impact_plan.PriceImpact(rows, impact.group_exceptions)
    reports = {
        "impact_nulls": impact_plan.null_suggestion_skus(impact, cats),
        "impact_sku": impact_plan.impact_by_sku(rows, cats),
        "impact_store": impact_plan.impact_by_store(rows, cats),
        "impact_subdept": impact_plan.coverage_by_subdept(rows).orderBy("store", "dept", "subdept"),
        "impact_counts": impact_plan.suggestion_counts(rows).orderBy("store", "priority", "suggested_source"),
        "impact_promos": impact_plan.promo_fallback_report(rows),
    }
    for name, report in reports.items():
        save_table(report, f"{out}/{name}_{period}")
    return impact


def run_week(
    spark: SparkSession,
    *,
    period: int,
    sales: DataFrame,
    impact_sales: DataFrame,
    prices: DataFrame,
    inventory: DataFrame,
    snapshot: DataFrame,
    cats: Catalogues,
    out: str,
    look_back: tuple[int, int] = (0, 6),
    fact_options: dict | None = None,
    price_options: dict | None = None,
    impact_options: dict | None = None,
) -> impact_plan.PriceImpact:
    cats = kept_catalogues(spark, cats, out)
    stats = run_competitor_stats(spark, prices, cats.matrix, period, out, *look_back)
    fact = run_fact_table(spark, sales, prices, inventory, stats, cats, period, out, **(fact_options or {}))
    suggested = run_suggested_prices(spark, fact, cats, period, out, **(price_options or {}))
    return run_price_impact(
        spark, suggested.rows, snapshot, impact_sales, cats, period, out, **(impact_options or {})
    )
