"""The wide table of one regulation week: sales, competitor prices, central prices."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import fields
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.prices import (
    DEFAULT_PROMO_PERCENT,
    clearance_flag,
    drop_flag,
    gross,
    unit_price,
)
from shelfwise.functions.weeks import midweek_date, rebase_week, week_before
from shelfwise.operators.dims import Catalogues
from shelfwise.operators.matching import (
    OBSERVATION,
    central_price_asof,
    inventory_universe,
    priority_pick,
)
from shelfwise.operators.pricestats import FORMAT_PERCENTILES, STORE_HISTORY_PERCENTILES
from shelfwise.operators.ranking import quantile_cuts
from shelfwise.plans.competitor_stats import (
    NATIONAL_MEASURES,
    RECENT_MEASURES,
    STORE_HISTORY_MEASURES,
    CompetitorStats,
)
from shelfwise.session import apart, part, parts_of, settled, stage

DEFAULT_TARGET_MARGIN = 0.17
HIERARCHY = ["dept", "subdept", "class_id", "subclass_id"]

# what the joins bring to a row of the fact table; the metrics made of it come after
LINE = ["period", "store", "sku", "upc", "units", "amount", "cost", "avg_price"]
CHOICE = ["priority", "comp_store", "comp_source", "comp_chain"]
SEEN_PRICES = ["comp_price", "comp_price_now", "comp_price_recent", "recent_period"]
HISTORY = [f"hist_{m}" for m in (*STORE_HISTORY_MEASURES, *STORE_HISTORY_PERCENTILES)]
MARKET = [f"{prefix}_{m}" for prefix in ("market", "market_now") for m in NATIONAL_MEASURES if m != "mode_freq"]
RECENT_MARKET = ["recent_market_period", *(f"recent_market_{m}" for m in RECENT_MEASURES if m != "mode_freq")]
CENTRAL = ["central_price", "stock_units", "stock_value", "stock_cost"]
TERMS = ["target_margin", "store_decile", "national_decile"]


def sku_terms(cats: Catalogues) -> DataFrame:
    """Taxes, margin, promotion limit and national decile of every article.

    All of these hang on the article, so they are put together on the small side and
    reach the sales lines in one join.
    """
    return (
        cats.skus.select("sku", "upc", *HIERARCHY)
        .join(cats.taxes, "sku", "inner")
        .join(cats.national_deciles.drop("upc"), "sku", "left")
        .join(cats.promo_limits, ["dept", "subdept"], "left")
        .join(cats.margins, ["dept", "subdept", "class_id"], "left")
    )


def sales_lines(sales: DataFrame, skus: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """Sales with the catalogue's hierarchy, the other columns of ``skus`` and the average price.

    With ``inventory`` every stocked (store, sku) is a line, sold or not.
    """
    if inventory is not None:
        sales = inventory_universe(inventory, sales)
    return (
        sales.drop("upc", *HIERARCHY)
        .join(skus, "sku", "inner")
        .filter(F.col("upc").isNotNull())
        .withColumn("avg_price", unit_price(F.col("amount"), F.col("units")))
    )


def sales_price_stats_by_format(
    lines: DataFrame, stores: DataFrame, by: Sequence[str] = (), near: Sequence[str] = ()
) -> DataFrame:
    """Average prices lie on no grid, so they are not counted by value; their cuts are exact all the same."""
    sold = lines.filter(F.col("avg_price") != 0).join(stores.select("store", "format"), "store", "inner")
    shares = {"median": 0.5, **FORMAT_PERCENTILES}
    plain = {"avg": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
    key = [*by, "sku", "upc", "format"]
    extra = [f("avg_price").alias(f"format_price_{name}") for name, f in plain.items()]
    out = quantile_cuts(sold, key, ["avg_price"], list(shares.values()), extra, near=near)
    cuts = {f"format_price_{name}": F.col("avg_price_cuts")[i] for i, name in enumerate(shares)}
    names = ("avg", "std", "median", "min", "max", *FORMAT_PERCENTILES)
    return out.withColumns(cuts).select(*key, *(f"format_price_{name}" for name in names))


def week_prices(prices: DataFrame, period: int, name: str) -> DataFrame:
    known = (F.col("period") == period) & F.col("comp_price").isNotNull()
    return prices.filter(known).select(*OBSERVATION, F.col("comp_price").alias(name))


def fact_metrics(rows: DataFrame, fill_with_mode: bool = True) -> DataFrame:
    """All derived columns, in two selects."""
    c = F.col

    def taxed(name: str) -> Column:
        return gross(c(name), c("iva"), c("ieps"))

    def filled(price: str, mode: str) -> Column:
        return F.coalesce(c(price), c(mode)) if fill_with_mode else c(price)

    def sold_at(price: Column) -> Column:
        return price * c("units")

    hist, limit = c("hist_median"), c("promo_percent")
    central_sales = sold_at(c("central_price"))
    first = rows.withColumns(
        {
            "target_margin": F.coalesce(c("target_margin"), F.lit(DEFAULT_TARGET_MARGIN)),
            "promo_percent": F.coalesce(c("promo_percent"), F.lit(DEFAULT_PROMO_PERCENT)).cast("double"),
            "comp_source_original": c("comp_source"),
            "comp_source": F.when(c("comp_price").isNull(), schemas.MODE_SOURCE).otherwise(c("comp_source")),
            "comp_price": filled("comp_price", "market_mode"),
            "comp_price_now": filled("comp_price_now", "market_now_mode"),
            "avg_price_gross": taxed("avg_price"),
            "central_price_gross": taxed("central_price"),
            "amount_gross": taxed("amount"),
            "central_sales": central_sales,
            "central_sales_gross": gross(central_sales, c("iva"), c("ieps")),
        }
    )
    units, cost = c("units"), c("cost")
    simulated = c("comp_price_now") - c("comp_price")
    real = c("avg_price_gross") - c("central_price_gross")
    cupc = units * (c("comp_price") - c("central_price_gross"))
    cuic = units * (simulated - real)
    promo_recent = drop_flag(c("comp_price_recent"), hist, limit)
    return first.withColumns(
        {
            "comp_sales": sold_at(c("comp_price")),
            "comp_sales_now": sold_at(c("comp_price_now")),
            "margin_gross": c("amount_gross") - cost,
            "comp_margin": sold_at(c("comp_price")) - cost,
            "comp_margin_now": sold_at(c("comp_price_now")) - cost,
            "central_margin_gross": c("central_sales_gross") - cost,
            "cup": units * (c("comp_price") - c("avg_price_gross")),
            "cupc": cupc,
            "simulated_check_impact": simulated,
            "real_check_impact": real,
            "cuic": cuic,
            "cut": cupc + cuic,
            "comp_now_minus_sales": sold_at(c("comp_price_now")) - c("amount_gross"),
            "comp_minus_hist_median": c("comp_price") - hist,
            "clearance": clearance_flag(c("avg_price_gross"), hist),
            "comp_clearance": clearance_flag(c("comp_price"), hist),
            "comp_clearance_now": clearance_flag(c("comp_price_now"), hist),
            "promo": drop_flag(c("avg_price_gross"), hist, limit),
            "comp_promo": drop_flag(c("comp_price"), hist, limit),
            "comp_promo_now": drop_flag(c("comp_price_now"), hist, limit),
            "comp_promo_recent": F.when(
                promo_recent == 0, clearance_flag(c("comp_price_recent"), c("recent_market_mode"))
            ).otherwise(promo_recent),
        }
    )


def fact_table(
    sales: DataFrame,
    prices: DataFrame,
    inventory: DataFrame,
    stats: CompetitorStats,
    cats: Catalogues,
    period: int,
    *,
    universe: DataFrame | None = None,
    asof: date | None = None,
    fill_with_mode: bool = True,
    rebase: bool = True,
) -> DataFrame:
    """One row per sales line and best competitor store.

    ``universe``: an inventory snapshot whose (store, sku) pairs are used instead of the
    sales lines. ``rebase`` puts week numbers into the year of ``period``.
    """

    def rows() -> DataFrame:
        lines = staged_lines(sales, cats, universe)
        then = near_upc(week_prices(prices, week_before(period, 2), "comp_price"))
        now = near_upc(week_prices(prices, period, "comp_price_now"))
        known = CompetitorStats(**{f.name: near_upc(getattr(stats, f.name)) for f in fields(stats)})
        chosen = chosen_lines(lines, lambda: (then, now, known), cats)
        central = settled(lines.sparkSession, "central", lambda: central_price_asof(inventory, asof or midweek_date(period)))
        return fact_rows(lines, chosen, central, cats)

    fact = fact_columns(apart(sales.sparkSession, rows), cats, fill_with_mode=fill_with_mode)
    if rebase:
        fact = fact.withColumn("period", rebase_week(F.col("period"), period // 100))
    return fact


def staged_lines(sales: DataFrame, cats: Catalogues, universe: DataFrame | None = None) -> DataFrame:
    """Sales lines, written once: the choice of competitor, the rows and the statistics by format start from them.

    The choice comes before taxes, which drop articles that have none.
    """
    return stage(sales_lines(sales, cats.skus.select("sku", "upc", *HIERARCHY), universe), "sales_lines")


def near_upc(df: DataFrame) -> DataFrame:
    """Rows dealt by UPC, where tables about competitor prices meet; tables without UPC are small and stay as they are."""
    return df.repartition("upc") if "upc" in df.columns else df


def chosen_lines(
    lines: DataFrame,
    known: Callable[[], tuple[DataFrame, DataFrame, CompetitorStats]],
    cats: Catalogues,
    by: Sequence[str] = (),
) -> DataFrame:
    """Staged lines with their best competitor stores and all that is known about these, as a stage table.

    ``known`` gives the prices of both weeks and the statistics, all dealt by UPC; stage tables it makes are
    removed afterwards. Without ``by`` all of these are of one run. With it they have these columns too, and
    each line meets what is known for its own values of them. As every table is dealt by UPC, none is
    shuffled again, and the UPCs can be done part by part.
    """
    observation = [*by, *OBSERVATION]
    parts = parts_of(lines)
    tables: list = []

    def build(nth: int) -> DataFrame:
        if not tables:
            tables.extend(known())
        some = lambda df: part(df, "upc", lines, nth, parts)
        then, now, stats = some(tables[0]), some(tables[1]), tables[2]
        own = near_upc(some(lines))
        # everything known about a competitor store and article is attached to the few
        # picked rows, before these meet the sales lines
        recent = some(stats.recent_store)
        picked = priority_pick(own, cats.matrix, then, now, recent.filter(F.col("comp_price_recent").isNotNull()), by)
        for table in (then, now, recent, some(stats.store_history)):
            picked = picked.join(table, observation, "left")
        for table in (stats.national, stats.recent_national):
            picked = picked.join(some(table), [*by, "upc"], "left")
        key = [*by, "store", "upc", "dept", "subdept"]
        picked = picked.select(*key, *CHOICE, *SEEN_PRICES, *HISTORY, *MARKET, *RECENT_MARKET)
        return own.select(*LINE, "dept", "subdept").join(picked, key, "inner").drop("dept", "subdept")

    return settled(lines.sparkSession, "chosen_lines", build, together=True, parts=parts)


def fact_rows(
    lines: DataFrame, chosen: DataFrame, central: DataFrame, cats: Catalogues, by: Sequence[str] = ()
) -> DataFrame:
    """``chosen_lines`` with central prices, catalogues and the statistics by format of all lines, as a stage table.

    All of these hang on articles, so every table is dealt by article once, and part by part. What can be
    computed from a row alone comes after that, in ``fact_columns``.
    """
    parts = parts_of(chosen)

    def build(nth: int) -> DataFrame:
        some = lambda df: part(df, "sku", lines, nth, parts)
        by_format = sales_price_stats_by_format(some(lines), cats.stores, by, near=["sku"])
        return (
            some(chosen).repartition("sku")
            .join(some(central), [*by, "sku", "store"], "left")
            .join(some(cats.store_deciles), ["sku", "store"], "left")
            .join(some(sku_terms(cats)).drop("upc", *HIERARCHY), "sku", "inner")
            .join(cats.stores, "store", "inner")
            .join(by_format, [*by, "sku", "upc", "format"], "left")
            .join(some(cats.skus).drop("upc"), "sku", "left")
        )

    return settled(lines.sparkSession, "fact_rows", build, together=True, parts=parts)


def _beside(columns: Sequence[str], keys: Sequence[str], other: Sequence[str]) -> list[str]:
    return [*keys, *(c for c in columns if c not in keys), *(c for c in other if c not in keys)]


def fact_columns(
    rows: DataFrame, cats: Catalogues, by: Sequence[str] = (), fill_with_mode: bool = True
) -> DataFrame:
    """The fact table of staged ``fact_rows``: nothing is joined or shuffled any more."""
    known = fact_metrics(rows, fill_with_mode)
    metrics = [c for c in known.columns if c not in rows.columns]
    columns = [*LINE, *CHOICE, *SEEN_PRICES, *HISTORY, *MARKET, *RECENT_MARKET, *CENTRAL, *metrics, *TERMS]
    columns = _beside(columns, ["store"], cats.stores.columns)
    columns = _beside(columns, [*by, "sku", "upc", "format"], [c for c in rows.columns if c.startswith("format_price_")])
    return known.select(*_beside(columns, ["sku"], cats.skus.drop("upc").columns))
