from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfwise.functions import prices as px
from shelfwise.functions import weeks as wk
from tests.conftest import as_set

# fixed values: price and the ending it goes to
ENDINGS = {
    0.00: 0.0, 0.02: 0.0, 0.03: 0.05, 0.07: 0.05, 0.08: 0.1, 9.99: 10.0, 12.30: 12.3, 12.32: 12.3,
    12.33: 12.35, 12.34: 12.35, 12.344: 12.35, 12.37: 12.35, 12.375: 12.4, 12.38: 12.4, 99.92: 99.9,
    99.93: 99.95, 99.97: 99.95, 99.98: 100.0, 99.999: 100.0, 100.00: 100.0, 100.44: 100.0, 100.45: 101.0,
    100.49: 101.0, 100.50: 101.0, 149.95: 150.0, 200.44: 200.0, 200.45: 200.0, 200.46: 201.0,
    1000.45: 1001.0, 1000.46: 1001.0, -1.23: -1.25,
}


def test_ending_price(spark, table):
    df = table("x double", *((x,) for x in ENDINGS), (None,))
    got = {row.x: row.y for row in df.select("x", px.ending_price(F.col("x")).alias("y")).collect()}
    assert got == {**ENDINGS, None: None}


def test_ending_price_keeps_allowed_endings(spark):
    cents = spark.range(0, 30_000).select((F.col("id") / 100).alias("x"))
    once = cents.select("x", px.ending_price(F.col("x")).alias("y"))
    moved_twice = once.filter(px.ending_price(F.col("y")) != F.col("y"))
    low_far = once.filter((F.col("x") < 100) & (F.abs(F.col("x") - F.col("y")) > 0.0251))
    assert moved_twice.count() == 0 and low_far.count() == 0


def test_clearance_ending(table):
    df = table("x double", (12.01,), (12.02,), (7.03,), (12.10,), (12.011,), (12.04,))
    assert [r[0] for r in df.select(px.clearance_ending(F.col("x"))).collect()] == [True] * 3 + [False] * 3


def test_drop_flag_limits_and_nulls(table):
    df = table(
        "p double, r double, l double",
        (80.0, 100.0, 20.0), (80.01, 100.0, 20.0), (40.0, 100.0, 60.0), (40.01, 100.0, 60.0),
        (100.0, 100.0, 0.0), (None, 100.0, 20.0), (80.0, None, 20.0), (80.0, 100.0, None), (1.0, 0.0, 20.0),
    )
    got = [r[0] for r in df.select(px.drop_flag(F.col("p"), F.col("r"), F.col("l"))).collect()]
    assert got == [1, 0, 1, 0, 0, None, None, None, 0]


def test_unit_price_without_units(table):
    df = table("a double, u double", (10.0, 4.0), (10.0, 0.0), (-10.0, 4.0), (10.0, -4.0))
    plain = [r[0] for r in df.select(px.unit_price(F.col("a"), F.col("u"))).collect()]
    strict = [r[0] for r in df.select(px.unit_price(F.col("a"), F.col("u"), True)).collect()]
    assert plain == [2.5, None, -2.5, -2.5] and strict == [2.5, None, None, None]


def test_gross_and_percent(table):
    df = table("a double, iva double, ieps double", (100.0, 160.0, 80.0))
    assert df.select(px.gross(F.col("a"), F.col("iva"), F.col("ieps"))).first()[0] == 124.0
    df = table("n long, m long", (1, 3), (2, 3), (1, 8), (0, 0))
    assert [r[0] for r in df.select(px.percent_of(F.col("n"), F.col("m"))).collect()] == [33, 67, 13, None]


def test_week_shift_over_all_weeks(spark, table):
    weeks = []
    day = date(1995, 1, 2)
    while day < date(2026, 12, 28):
        weeks.append((day.isocalendar()[0] * 100 + day.isocalendar()[1], day.isoformat()))
        day += timedelta(weeks=1)
    df = table("w int, monday string", *weeks)
    for back in (0, 1, 2, 6, 52, -1):
        expected = {
            (w, (lambda c: c[0] * 100 + c[1])((date.fromisoformat(m) - timedelta(weeks=back)).isocalendar()))
            for w, m in weeks
        }
        assert as_set(df.select("w", wk.shift_week(F.col("w"), back).alias("s")), "w", "s") == expected
        assert {(w, wk.week_before(w, back)) for w, _ in weeks} == expected
    friday = df.select("w", wk.midweek_day(F.col("w")).alias("f"))
    assert as_set(friday, "w", "f") == {(w, date.fromisoformat(m) + timedelta(days=4)) for w, m in weeks}
    assert all(wk.midweek_date(w) == date.fromisoformat(m) + timedelta(days=4) for w, m in weeks)


def test_rebase_week(table):
    assert table("w int", (201603,)).select(wk.rebase_week(F.col("w"), 2018)).first()[0] == 201803
