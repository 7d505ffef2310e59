"""Many weeks in one job against each week run alone, as-of days against a scan, and re-runs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from registry.roles import Roles
from shelfwise.functions.weeks import midweek_date, week_before
from shelfwise.operators.asof import asof_rows, latest_days
from shelfwise.operators.sliding import in_windows, look_back_windows, run_periods, weeks_back
from shelfwise.plans.competitor_stats import competitor_stats, look_back_prices
from shelfwise.plans.fact_table import fact_table
from shelfwise.plans.weekly_runs import asof_inventory_by_week, competitor_stats_by_week, weekly_runs
from shelfwise.session import stage
from shelfwise.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, SF_DIR)


def comparable(df, columns):
    show = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(show(v) for v in row) for row in df.select(*columns).collect()), key=str)


def some_weeks(roles):
    weeks = [r.period for r in roles.sales.select("period").distinct().orderBy("period").collect()]
    first_of_a_year = next(w for w in weeks if w % 100 == 1 and w > weeks[60])
    return [weeks[0], weeks[40], first_of_a_year, weeks[-1]]


def test_each_week_as_if_run_alone(roles):
    every = stage(weekly_runs(roles.sales, roles.prices, roles.inventory, roles.cats), "every_week")
    for week in some_weeks(roles):
        base = look_back_prices(roles.prices, roles.cats.matrix, week)
        alone = fact_table(
            roles.sales.filter(F.col("period") == week), roles.prices, roles.inventory, competitor_stats(base, week), roles.cats, week
        )
        got = comparable(every.filter(F.col("period") == week), alone.columns)
        assert got == comparable(alone, alone.columns) and got


def test_excluded_weeks_do_not_run_but_are_looked_back_at(roles):
    out = weekly_runs(roles.sales, roles.prices, roles.inventory, roles.cats, exclude=(week := some_weeks(roles)[1:2]))
    every = roles.weekly_fact
    assert comparable(out, every.columns) == comparable(every.filter(F.col("period") != week[0]), every.columns)


def test_windows_cross_years(spark, table):
    runs = run_periods(table("period int", (201801,), (201801,), (None,), (202053,), (202102,), (201750,)), exclude=[201750])
    got = {(r.period, r.back, r.seen_period) for r in look_back_windows(runs, 3, 0).collect()}
    assert got == {(w, k, week_before(w, k)) for w in (201801, 202053, 202102) for k in range(4)}


def test_prices_reach_every_week_that_looks_back(spark, table):
    weekly = table("period int, v string", (201752, "a"), (201801, "b"), (201701, "c"))
    windows = look_back_windows(table("period int", (201801,), (201802,), (201803,)), 0, 2)
    assert {(r.period, r.v) for r in in_windows(weekly, windows).collect()} == {
        (201801, "a"), (201801, "b"), (201802, "a"), (201802, "b"), (201803, "b"),
    }
    assert [(r.period, r.v) for r in weeks_back(weekly, windows, 1).orderBy("period").collect()] == [(201801, "a"), (201802, "b")]


def test_repeated_prices_of_the_latest_week_stay(spark, table):
    prices = table(
        "period int, upc long, comp_store int, comp_source string, comp_price double",
        (201801, 1, 1, "s", 5.0), (201801, 1, 1, "s", 5.0), (201801, 1, 1, "s", 7.0), (201752, 1, 1, "s", 9.0), (201801, 1, 2, "s", None),
    )
    matrix = table("comp_store int, comp_source string", (1, "s"), (2, "s"))
    stats = competitor_stats_by_week(prices, matrix, table("period int", (201801,), (201802,), (201810,)))
    assert comparable(stats.recent_store, ["period", "recent_period", "comp_price_recent"]) == [
        (week, 201801, price) for week in (201801, 201802) for price in (5.0, 5.0, 7.0)
    ]
    assert comparable(stats.store_history, ["period", "hist_min", "hist_max", "hist_median"]) == [(201801, 5.0, 9.0, 5.0), (201802, 5.0, 9.0, 5.0)]


def scan(wanted, known, hot=None):
    out = []
    for sku, store, day in wanted:
        days = [d for a, b, d, _ in known if (a, b) == (sku, store) and d is not None and day is not None and d <= day]
        out.append((sku, store, day, max(days, default=None)))
    return sorted(out, key=str)


def test_as_of_days_of_hot_and_rare_keys(spark, table):
    rng = random.Random(4)
    start = date(2018, 1, 1)
    pick = lambda: (1, 1) if rng.random() < 0.5 else (rng.randrange(2, 30), rng.randrange(4))
    known = [(*pick(), start + timedelta(days=rng.randrange(60)), float(i)) for i in range(3000)] + [(2, 2, None, 0.0)]
    wanted = [(*pick(), start + timedelta(days=rng.randrange(-10, 80))) for _ in range(2000)] + [(1, 1, None), (99, 9, start), (None, 1, start)]
    stock = table("sku long, store int, stock_date date, stock_value double", *known).repartition(7)
    lines = table("sku long, store int, day date", *wanted).repartition(3)
    got = sorted((tuple(r) for r in latest_days(lines, stock, ["sku", "store"], "day", "stock_date").collect()), key=str)
    assert got == scan(wanted, known)
    rows = asof_rows(lines, stock, ["sku", "store"], "day", "stock_date").groupBy("sku", "store", "day").count().count()
    assert rows == len({w[:3] for w in scan(wanted, known) if w[3] is not None})


def test_a_hot_key_is_cut_into_slices(spark, table):
    days = spark.range(4000).select(F.lit(1).alias("k"), F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int")).alias("day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = stage(latest_days(days, days.filter("day > '2000-01-20'").withColumnRenamed("day", "known"), ["k"], "day", "known"), "days")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out.filter("NOT known <=> IF(day > '2000-01-20', day, NULL)").count() == 0 and out.count() == 4000
    assert out.select("_metadata.file_name").distinct().count() > 3


def test_as_of_friday(spark, table):
    stock = table("sku long, store int, stock_date date, stock_value double", (1, 1, date(2018, 1, 5), 1.0), (1, 1, date(2018, 1, 6), 2.0), (1, 1, date(2018, 1, 5), 3.0))
    lines = table("sku long, store int, period int", (1, 1, 201801), (1, 1, 201802), (1, 1, 201801), (1, 1, 201752), (2, 1, 201802))
    got = {(r.period, r.stock_value) for r in asof_inventory_by_week(stock, lines).collect()}
    assert midweek_date(201801) == date(2018, 1, 5) and got == {(201801, 1.0), (201801, 3.0), (201802, 2.0)}


def test_running_a_week_again_leaves_the_others(spark, table, tmp_path):
    path = str(tmp_path / "weeks")
    tables.save_periods(table("period int, v int", (1, 10), (1, 11), (2, 20), (3, 30)), path)
    tables.save_periods(table("period int, v int", (2, 21), (4, 40)), path)
    got = tables.union_saved(spark, [path])
    assert sorted((r.period, r.v) for r in got.collect()) == [(1, 10), (1, 11), (2, 21), (3, 30), (4, 40)]
    only = got.filter("period = 2")
    assert "PartitionFilters: [isnotnull(period" in only._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_empty_tables(spark, roles):
    none = roles.sales.limit(0)
    assert weekly_runs(none, roles.prices, roles.inventory, roles.cats).collect() == []
    assert weekly_runs(roles.sales, roles.prices.limit(0), roles.inventory.limit(0), roles.cats).filter("comp_price IS NOT NULL").count() == 0
