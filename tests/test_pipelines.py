from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from registry.roles import Roles
from shelfwise.functions.weeks import week_before
from shelfwise.operators.dims import Catalogues
from shelfwise.plans import descriptive, price_impact as impact_plan
from shelfwise.plans.fact_table import fact_metrics, sales_lines
from shelfwise.plans.suggested_prices import PRICE_COLUMNS, single_prices, suggested_prices
from shelfwise.plans.weekly import run_week
from tests.conftest import as_set

FACT = """sku long, upc long, dept int, subdept int, description string, store int, store_name string,
    comp_price_recent double, comp_promo_recent int, recent_market_mode double, recent_market_median double,
    hist_median double, priority int, comp_store int, comp_chain string, comp_source_original string"""


def fact(table, *rows):
    """Rows of (sku, price, promo, mode, priority, chain)."""
    full = [
        (sku, sku, 1, 1, "d", 1, "s", price, promo, mode, mode, price, prio, sku, chain, "f")
        for sku, price, promo, mode, prio, chain in rows
    ]
    return table(FACT, *full)


@pytest.fixture
def cats(table):
    empty = table("sku long", (1,)).limit(0)
    return Catalogues(
        stores=table(
            "store int, store_name string, format string, region string, zone string, store_type string",
            (1, "s", "F", "R", "Z", "T"),
        ),
        skus=table(
            "sku long, upc long, description string, status string, dept int, subdept int",
            *((s, s, "d", status, 1, 1) for s, status in ((1, "A"), (2, "A"), (3, "P"), (4, None), (5, "A"))),
        ),
        store_deciles=empty,
        national_deciles=table("sku long, upc long, national_decile int", (1, 1, 4)),
        taxes=table("sku long, iva double, ieps double", *((s, 160.0, 0.0) for s in range(1, 6))),
        matrix=empty,
        promo_limits=table("dept int, subdept int, promo_percent int", (9, 9, 5)),
        margins=empty,
        price_groups=table("sku long, price_group long", (1, 10), (2, 10)),
        exceptions=table("sku long, exception string", (5, "E")),
    )


def test_single_prices(table):
    rows = fact(
        table,
        (1, 10.0, 0, 9.0, 10001, "x"), (2, 10.0, 1, 9.0, 3, "x"), (3, None, None, 9.0, 11103, "x"),
        (4, 10.0, None, 9.0, 2, "x"), (5, 10.02, 0, 9.0, 2, "BODEGA AURRERA"), (6, 10.02, 0, 11.0, 2, "BODEGA AURRERA"),
    )
    plain = as_set(single_prices(rows), "sku", "suggested_price", "suggested_source", "priority")
    spot = "PrecioPuntual"
    assert plain == {
        (1, 10.0, spot, 1), (2, None, None, 10), (3, None, None, 10), (4, 10.0, spot, 2),
        (5, 10.02, spot, 2), (6, 10.02, spot, 2),
    }
    flagged = single_prices(rows, flag_clearance_endings=True, ignore_national_mode=False)
    assert as_set(flagged.filter("sku in (2, 5, 6)"), "sku", "suggested_price", "suggested_source", "priority") == {
        (2, 9.0, "ModaNacional", 10), (5, 9.0, "ModaNacional", 10), (6, 10.02, spot, 2),
    }


def test_group_decides_the_price(table, cats):
    rows = fact(table, (1, 101.2, 0, 9.0, 1, "x"), (2, None, None, 9.0, 1, "x"), (5, 55.43, 0, 9.0, 1, "x"))
    out = suggested_prices(rows, cats)
    assert as_set(out.rows, "sku", "suggested_price", "suggested_source", "group_sku") == {
        (1, 101.0, "PrecioPuntual", 1), (2, 101.0, "PrecioGrupo", 1), (5, 55.45, "PrecioPuntual", None),
    }
    assert as_set(out.regular, "sku") == {(1,), (2,)} and as_set(out.exceptional, "sku") == {(5,)}


def test_group_without_any_price(table, cats):
    rows = fact(table, (1, None, None, 9.32, 1, "x"), (2, 10.0, 1, 9.4, 1, "x"))
    none = suggested_prices(rows, cats).rows
    assert as_set(none, "sku", "suggested_price", "suggested_source") == {(1, None, None), (2, None, None)}
    rows = fact(table, (1, None, None, None, 1, "x"), (2, 10.0, 1, 9.43, 1, "x"))
    modes = suggested_prices(rows, cats, ignore_national_mode=False).rows
    assert as_set(modes, "sku", "suggested_price", "suggested_source") == {
        (1, 9.45, "PrecioGrupo"), (2, 9.45, "ModaNacional"),
    }


PRICES = """sku long, upc long, price_group long, store int, suggested_price double, suggested_source string,
    priority int, spot_price double, comp_store int, comp_chain string, comp_source string, store_median double,
    national_median double, national_mode double, group_price double, group_median double, group_mode double,
    group_sku long, group_priority int, group_comp_store int, group_comp_chain string, group_comp_source string"""


def _impact(table, cats, how="left", **options):
    prices = table(
        PRICES,
        (1, 1, 10, 1, 20.0, "PrecioPuntual", 1, 20.0, 1, "c", "f", 20.0, 19.0, 18.0, 20.0, 19.0, 18.0, 1, 1, 1, "c", "f"),
    )
    stock = table(
        "sku long, store int, stock_units double, stock_value double, stock_cost double",
        (1, 1, 10.0, 100.0, 0.0), (2, 1, 1.0, 10.0, 0.0), (3, 1, 1.0, 10.0, 0.0), (4, 1, 1.0, 10.0, 0.0),
        (5, 1, 1.0, 10.0, 0.0), (1, 300, 1.0, 1.0, 0.0), (1, 499, 1.0, 1.0, 0.0), (1, 686, 1.0, 1.0, 0.0),
    )
    sales = table(
        "sku long, store int, amount double, units double", (1, 1, 30.0, 2.0), (1, 7, 10.0, 1.0), (2, 1, -3.0, 1.0)
    )
    assert sorted(f.split()[0] for f in PRICES.split(",")) == sorted(PRICE_COLUMNS)
    return impact_plan.price_impact(prices, stock, sales, cats, how=how, **options)


def test_impact(table, cats):
    out = _impact(table, cats)
    # P and unknown status, exceptions and closed stores are left out; 10.00 + 16 % is 11.60
    assert as_set(
        out.rows, "sku", "store", "suggested_price", "suggested_source", "central_price_gross", "avg_price_gross"
    ) == {(1, 1, 20.0, "PrecioPuntual", 11.6, 17.4), (2, 1, 20.0, "PrecioGrupo", 11.6, None)}
    got = {r.sku: r for r in out.rows.collect()}
    assert got[1].impact_vs_central == pytest.approx(84.0) and got[1].impact_vs_average == pytest.approx(26.0)
    assert got[2].group_sku == 1 and got[2].impact_vs_average is None


def test_impact_keeps_sales_without_stock(table, cats):
    rows = _impact(table, cats, how="full").rows.filter("store = 7").collect()
    assert len(rows) == 1 and rows[0].stock_units is None and rows[0].impact_vs_central is None
    assert rows[0].avg_price_gross == 11.6


def test_impact_reports(table, cats):
    rows = table(
        """sku long, upc long, store int, dept int, subdept int, suggested_price double, suggested_source string,
        priority int, spot_price double, impact_vs_central double, impact_vs_average double""",
        (1, 1, 1, 1, 1, 5.0, "PrecioPuntual", 2, 5.0, 1.0, 2.0), (2, 2, 1, 1, 1, None, None, 2, None, None, None),
        (1, 1, 2, 1, 1, 5.0, "ModaNacional", None, 6.0, 3.0, None), (2, 2, 2, 1, 2, None, None, None, None, None, None),
        (3, 3, 2, 1, 2, None, None, None, None, None, None), (3, 3, 1, 1, 3, 7.0, "PrecioGrupo", 3, None, 1.0, 1.0),
    )
    cover = impact_plan.coverage_by_subdept(rows)
    assert as_set(cover, "store", "subdept", "priced", "unpriced", "percent_regulated") == {
        (1, 1, 1, 1, 50), (2, 1, 1, 0, 100), (2, 2, 0, 2, 0), (1, 3, 1, 0, 100),
    }
    both = impact_plan.coverage_by_subdept(rows, require_both=True)
    assert as_set(both, "store", "subdept") == {(1, 1)}
    counts = impact_plan.suggestion_counts(rows)
    assert (1, 2, "PrecioPuntual", 1) in as_set(counts, "store", "priority", "suggested_source", "n")
    assert (1, 0, "PrecioGrupo", 1) in as_set(counts, "store", "priority", "suggested_source", "n")
    assert as_set(impact_plan.promo_fallback_report(rows), "sku", "store") == {(1, 2)}
    impact = impact_plan.PriceImpact(
        rows, table("price_group long, group_exception_sku long, group_exception string", (99, 1, "E"))
    )
    nulls = impact_plan.null_suggestion_skus(impact, cats)
    assert as_set(nulls, "sku", "all_null") == {(2, 1), (3, 0)}
    assert as_set(impact_plan.impact_by_sku(rows, cats), "sku", "impact_vs_central") == {
        (1, 4.0), (2, None), (3, 1.0),
    }
    assert as_set(impact_plan.impact_by_store(rows, cats), "store", "impact_vs_central", "format") == {
        (1, 2.0, "F"), (2, 3.0, None),
    }


def test_missing_prices_take_the_mode_or_stay_null(table):
    names = """units cost amount avg_price central_price iva ieps comp_price comp_price_now comp_price_recent
        hist_median market_mode market_now_mode recent_market_mode target_margin""".split()
    schema = ", ".join(f"{n} double" for n in names) + ", promo_percent int, comp_source string"
    row = (2.0, 5.0, 20.0, 10.0, 8.0, 160.0, 0.0, None, None, 39.0, 50.0, 12.0, 14.0, 100.0, None, None, "f")
    filled = fact_metrics(table(schema, row)).first()
    assert (filled.comp_price, filled.comp_price_now, filled.comp_source) == (12.0, 14.0, "Moda")
    assert filled.comp_source_original == "f" and filled.target_margin == 0.17
    assert filled.cup == pytest.approx(2 * (12.0 - 11.6)) and filled.cut == pytest.approx(filled.cupc + filled.cuic)
    assert (filled.clearance, filled.promo, filled.comp_clearance_now) == (1, 1, 1)
    # 39 is 22 percent under the store median: a promotion at the default limit of 20
    assert filled.comp_promo_recent == 1
    kept = fact_metrics(table(schema, row), fill_with_mode=False).first()
    assert kept.comp_price is None and kept.cup is None and kept.comp_promo is None and kept.promo == 1


def test_recent_promo_second_step(table):
    names = """units cost amount avg_price central_price iva ieps comp_price comp_price_now comp_price_recent
        hist_median market_mode market_now_mode recent_market_mode target_margin""".split()
    schema = ", ".join(f"{n} double" for n in names) + ", promo_percent int, comp_source string"
    base = [2.0, 5.0, 20.0, 10.0, 8.0, 0.0, 0.0, None, None, 40.0, 41.0, None, None, 100.0, None, 20, "f"]
    no_history = [*base[:10], None, *base[11:]]
    out = fact_metrics(table(schema, tuple(base), tuple(no_history)))
    # not a promotion against the store, but 60 percent under the national mode
    assert [r.comp_promo_recent for r in out.collect()] == [1, None]


def test_sales_lines_of_an_inventory(table):
    sales = table("period int, sku long, store int, units double, amount double, cost double", (1, 1, 1, 0.0, 5.0, 1.0))
    skus = table("sku long, upc long, dept int, subdept int, class_id int, subclass_id int", (1, 7, 1, 1, 1, 1), (2, 8, 1, 1, 1, 1), (3, None, 1, 1, 1, 1))
    stock = table("sku long, store int", (1, 1), (2, 1), (3, 1), (4, 1))
    assert as_set(sales_lines(sales, skus), "sku", "avg_price") == {(1, None)}
    assert as_set(sales_lines(sales, skus, stock), "sku", "units") == {(1, 0.0), (2, None)}


def test_descriptive(table):
    sales = table(
        "sku long, upc long, period int, store int, units double, amount double",
        (1, 7, 1, 10, 1.0, 5.0), (1, 7, 1, 11, 2.0, 10.0), (1, 7, 1, 12, 1.0, 9.0), (2, 8, 1, 10, 0.0, 1.0),
        (3, None, 1, 10, 1.0, 1.0),
    )
    tax = table("sku long, iva double, ieps double", (1, 0.0, 0.0), (2, 0.0, 0.0), (3, 0.0, 0.0))
    assert as_set(descriptive.weekly_counts(sales), "stores", "articles") == {(3, 2)}
    taxed = descriptive.gross_sales(sales, tax)
    lists = descriptive.extreme_price_stores(taxed)
    assert as_set(lists, "sku", "stores_min", "stores_max") == {(1, "10:11", "12")}
    stats = {r.sku: r for r in descriptive.item_stats(taxed).collect()}
    assert stats[1].price_min == 5.0 and stats[1].stores == 3 and stats[2].price_std == 0.0
    skus = table("sku long, upc long, description string", (1, 7, "d"))
    assert descriptive.item_report(taxed, skus).count() == 2


def test_weekly_run_writes_every_stage(spark, tmp_path):
    roles = Roles(spark, "/root/testdata/sf0.001")
    period, out = 200140, str(tmp_path)
    stock = roles.inventory
    impact = run_week(
        spark,
        period=period,
        sales=roles.sales.filter(F.col("period") == period),
        impact_sales=roles.sales.filter(F.col("period") == week_before(period, 1)),
        prices=roles.prices,
        inventory=stock,
        snapshot=stock,
        cats=roles.cats,
        out=out,
        look_back=(6, 0),
        fact_options={"universe": stock},
        impact_options={"how": "left"},
    )
    read = lambda name: spark.read.parquet(f"{out}/{name}_{period}")
    prices = read("prices")
    assert prices.count() == read("fact").count() > 0
    regular = F.col("exception").isNull() & F.col("group_exception").isNull()
    assert prices.filter(regular != (F.col("part") == "regular")).count() == 0 and prices.select("part").distinct().count() == 2
    assert spark.read.parquet(f"{out}/catalogue_skus").count() == roles.cats.skus.count()
    assert impact.rows.count() == read("impact").count() > 0
    assert read("store_history").count() > 0 and read("impact_counts").agg(F.sum("n")).first()[0] == impact.rows.count()
    for name in ("national", "recent_national", "recent_store", "impact_nulls", "impact_sku", "impact_store", "impact_subdept", "impact_promos", "prices_auxiliary"):
        assert read(name).columns


def test_catalogues_can_be_replaced(cats, table):
    margins = table("dept int, subdept int, class_id int, target_margin double", (1, 1, 1, 0.3))
    assert replace(cats, margins=margins).margins.count() == 1
