import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import prices as px
from shelfwise.operators import dims, groups, matching, picks, pricestats, ranking, rollups
from tests.conftest import as_set

OBS = "upc long, comp_store int, comp_source string"


def disc(values, share):
    values = sorted(values)
    return values[max(-(-len(values) * round(share * 10_000) // 10_000), 1) - 1]


def test_price_stats_against_brute_force_with_a_hot_key(spark, table):
    rng = random.Random(7)
    # key 1 holds a third of the rows, key 9 a single one
    rows = [(1, rng.choice([9.98, 10.02, 10.03, 12.5, 99.99, 150.45])) for _ in range(1000)]
    rows += [(rng.randint(2, 8), round(rng.uniform(0, 300), 2)) for _ in range(2000)] + [(9, 4.0), (9, None)]
    df = table("k int, p double", *rows)
    measures = ("avg", "std", "min", "max", "median", "mode", "mode_freq", "count")
    got = pricestats.price_stats(df, ["k"], "p", "x", measures, {"p10": 0.1, "p95": 0.95})
    endings = {
        r.p: r.e for r in df.select("p", px.ending_price(F.col("p")).alias("e")).distinct().collect()
    }
    by_key = defaultdict(list)
    for k, p in rows:
        if p is not None:
            by_key[k].append(p)
    found = {r.k: r for r in got.collect()}
    assert set(found) == set(by_key)
    for k, values in by_key.items():
        r = found[k]
        freq = Counter(endings[v] for v in values)
        top = max(freq.values())
        assert r.x_mode_freq == top and r.x_mode == min(e for e, n in freq.items() if n == top)
        assert (r.x_min, r.x_max, r.x_count) == (min(values), max(values), len(values))
        assert (r.x_median, r.x_p10, r.x_p95) == (disc(values, 0.5), disc(values, 0.1), disc(values, 0.95))
        assert r.x_avg == pytest.approx(statistics.fmean(values))
        if len(values) == 1:
            assert r.x_std is None
        else:
            assert r.x_std == pytest.approx(statistics.stdev(values))


def test_mode_tie_takes_the_lower_price(table):
    df = table("k int, p double", (1, 10.0), (1, 10.01), (1, 20.0), (1, 20.02), (1, 30.0))
    row = pricestats.price_stats(df, ["k"], "p", "x", ("mode", "mode_freq")).first()
    assert (row.x_mode, row.x_mode_freq) == (10.0, 2)


def test_two_period_stats_keep_the_earlier_week(table):
    stats = table("upc long, period int, m_avg double", (1, 201801, 5.0), (1, 201803, 6.0), (2, 201803, 7.0))
    out = pricestats.two_period_stats(stats, "then", "now").filter("period = 201803")
    assert as_set(out, "upc", "then_avg", "now_avg") == {(1, 5.0, 6.0)}


def test_latest_rows_keep_ties(table):
    df = table(
        f"period int, {OBS}, comp_price double",
        (201801, 1, 1, "a", 5.0), (201802, 1, 1, "a", 6.0), (201802, 1, 1, "a", 7.0), (201803, 1, 1, "a", None),
        (201801, 1, 2, "a", 8.0),
    )
    out = matching.latest_price_per_store(df)
    assert as_set(out, "comp_store", "recent_period", "comp_price_recent") == {
        (1, 201802, 6.0), (1, 201802, 7.0), (2, 201801, 8.0),
    }


def test_one_per_key_is_one_whole_row(table):
    df = table("k int, a string, b int", (1, "y", 1), (1, "x", 2), (1, None, 3), (2, "z", 4))
    assert as_set(picks.one_per_key(df, ["k"]), "k", "a", "b") == {(1, "x", 2), (2, "z", 4)}
    assert as_set(picks.one_per_key(df, ["k"], ["a"], ["b"]), "k", "a") == {(1, "y"), (2, "z")}


def _pick(table, then, now, recent, matrix=None):
    demand = table("store int, dept int, subdept int, upc long", (1, 1, 1, 7), (1, 1, 1, 7))
    matrix = matrix or [(1, p, 1, 1, p, "a", "c") for p in (1, 2, 3)]
    m = table(
        "store int, priority int, dept int, subdept int, comp_store int, comp_source string, comp_chain string",
        *matrix,
    )
    seen = [table(OBS, *((7, s, "a") for s in stores)) if stores else table(OBS).limit(0) for stores in (then, now, recent)]
    out = matching.priority_pick(demand, m, *seen)
    return as_set(out, "comp_store", "priority")


def test_priority_penalties(table):
    everywhere = (1, 2, 3)
    assert _pick(table, everywhere, everywhere, everywhere) == {(1, 1)}
    # the earlier week weighs most, then the current one, then the recent price
    assert _pick(table, (3,), (1, 2), everywhere) == {(3, 1003)}
    assert _pick(table, everywhere, (2,), everywhere) == {(2, 2)}
    assert _pick(table, (), (), (2,)) == {(2, 11002)}
    assert _pick(table, (), (), ()) == {(1, 11101)}
    base = table("p int", (11101,), (3,)).select(matching.base_priority(F.col("p")))
    assert [r[0] for r in base.collect()] == [1, 3]


def test_priority_ties_are_kept_across_departments(table):
    demand = table("store int, dept int, subdept int, upc long", (1, 1, 1, 7), (1, 2, 1, 7))
    m = table(
        "store int, priority int, dept int, subdept int, comp_store int, comp_source string, comp_chain string",
        (1, 1, 1, 1, 5, "a", "c"), (1, 1, 2, 1, 6, "a", "c"), (1, 2, 2, 1, 7, "a", "c"),
    )
    none = table(OBS, (99, 1, "a"))
    out = matching.priority_pick(demand, m, none, none, none)
    assert as_set(out, "dept", "comp_store") == {(1, 5), (2, 6)}


def test_asof_inventory(table):
    df = table(
        "sku long, store int, stock_date date, stock_units double, stock_value double, stock_cost double",
        (1, 1, date(2018, 1, 1), 1.0, 10.0, 0.0), (1, 1, date(2018, 1, 5), 2.0, 30.0, 0.0),
        (1, 1, date(2018, 1, 9), 3.0, 90.0, 0.0), (2, 1, date(2018, 1, 5), 0.0, 5.0, 0.0),
        (3, 1, date(2018, 2, 1), 1.0, 1.0, 0.0),
    )
    out = matching.central_price_asof(df, date(2018, 1, 5))
    assert as_set(out, "sku", "central_price") == {(1, 15.0), (2, None)}


def test_store_membership_and_reconcile(table):
    left, right = table("store string", ("1",), ("2",), ("x",)), table("store int", (2,), (3,))
    assert as_set(matching.store_membership(left, right), "store", "found_in") == {
        (1, "left"), (2, "both"), (3, "right"),
    }
    matrix = table("store int, n string", (1, "a"), (2, "b"))
    feeds = [table("n string", ("a",), ("a",)), table("n string", ("c",))]
    out = matching.reconcile_names(matrix, feeds, "n")
    assert as_set(out, "store", "n_in_matrix", "n_in_feeds") == {(1, "a", "a"), (2, "b", None)}


GROUP_ROWS = """store int, price_group long, sku long, suggested_price double, priority int,
    promo_percent int, comp_store int, comp_chain string, comp_source string"""


def _groups(table, rows, **options):
    df = table(GROUP_ROWS, *((1, g, sku, price, prio, 20, sku, "c", "s") for g, sku, price, prio in rows))
    out = groups.group_prices(df, **options)
    return as_set(out, "price_group", "group_store_median", "group_price", "group_sku")


def test_group_price_pool(table):
    # the cheap price has a low priority: it does not move the median but may be the minimum
    rows = [(1, 10, 100.0, 1), (1, 11, 102.0, 1), (1, 12, 90.0, 2)]
    assert _groups(table, rows) == {(1, 100.0, 90.0, 12)}
    assert _groups(table, rows, pool="top_priority") == {(1, 100.0, 100.0, 10)}
    with pytest.raises(ValueError):
        _groups(table, rows, pool="some")


def test_group_price_leaves_out_low_prices(table):
    rows = [(1, 10, 100.0, 1), (1, 11, 102.0, 1), (1, 12, 80.0, 1)]
    # the median is 100, so 80 is exactly 20 percent below it
    assert _groups(table, rows) == {(1, 100.0, 100.0, 10)}
    assert _groups(table, rows, drop_low_prices=False) == {(1, 100.0, 80.0, 12)}


def test_group_price_ignores_rows_without_group_or_price(table):
    rows = [(None, 1, 5.0, 1), (2, 2, None, 1), (3, 3, 7.0, 1), (3, 4, 7.0, 1)]
    assert _groups(table, rows) == {(3, 7.0, 7.0, 3)}


def test_group_median_weighs_repeated_prices(table):
    rows = [(1, sku, 50.0, 1) for sku in range(5)] + [(1, 9, 60.0, 1)]
    assert _groups(table, rows) == {(1, 50.0, 50.0, 0)}


def test_exceptions_split(table):
    df = table(
        "sku long, exception string, group_exception string",
        (1, None, None), (2, "E", None), (3, None, "E"), (4, "E", "E"),
    )
    regular, exceptional = groups.split_exceptions(df)
    assert as_set(regular, "sku") == {(1,)} and as_set(exceptional, "sku") == {(2,), (3,), (4,)}


def test_group_exceptions_among(table):
    exc = table("sku long, exception string", (5, "E"), (3, "F"), (8, None))
    grp = table("sku long, price_group long", (5, 1), (3, 1), (8, 2))
    out = groups.group_exceptions(exc, grp)
    assert as_set(out, "price_group", "group_exception_sku", "group_exception") == {(1, 3, "F"), (2, 8, None)}
    out = groups.group_exceptions(exc, grp, table("sku long", (5,), (8,)))
    assert as_set(out, "price_group", "group_exception_sku") == {(1, 5)}


def test_dims(table):
    dec = table(
        "sku long, store int, decile string, valid_from date, valid_to date",
        (1, 1, "2", date(2018, 1, 1), None), (1, 1, "3", date(2018, 2, 1), None), (1, 1, "4", date(2018, 2, 1), None),
    )
    assert as_set(dims.store_deciles(dec), "store_decile") == {("3",), ("4",)}
    nat = table("sku long, upc long, decile string", (1, 1, "N D7"), (1, 1, "N D10"), (2, 2, None))
    assert as_set(dims.national_deciles(nat), "sku", "national_decile") == {(1, 7), (2, None)}
    bad = table("sku long, upc long, decile string", (1, 1, "seven"))
    with pytest.raises(Exception, match="Unexpected decile label"):
        dims.national_deciles(bad).collect()
    assert as_set(dims.national_deciles(bad, strict=False), "national_decile") == {(None,)}
    tax = table("sku long, iva double, ieps double", (1, None, 80.0))
    assert as_set(dims.taxes(tax), "iva", "ieps") == {(0.0, 80.0)}
    matrix = table(
        "store int, priority int, dept int, subdept int, comp_store int, comp_source string, comp_chain string",
        (1, 1, 1, 1, 5, "b", "c"), (1, 1, 1, 1, 5, "a", "d"), (None, 1, 1, 1, 5, "a", "d"), (1, 2, 1, 1, None, "a", "d"),
    )
    assert as_set(dims.competition_matrix(matrix), "comp_source", "comp_chain") == {("a", "d")}


def test_cumulative_share_of_a_hot_group(spark, table):
    rng = random.Random(3)
    # group 1 holds most rows, a third of them with the very same value
    rows = [(1, i, 5.0 if i % 3 else float(rng.randint(1, 99))) for i in range(3000)]
    rows += [(None if i % 7 == 0 else 2 + i % 4, i, rng.uniform(1, 50)) for i in range(300)]
    df = table("g int, id int, v double", *rows).repartition(8)
    out = ranking.cumulative_share(df, ["g"], "v", ["id"])
    expected = {}
    by_group = defaultdict(list)
    for g, i, v in rows:
        by_group[g].append((-v, i))
    for g, members in by_group.items():
        total, running = sum(-v for v, _ in members), 0.0
        for v, i in sorted(members):
            running -= v
            expected[g, i] = (total, running)
    found = {(r.g, r.id): r for r in out.collect()}
    assert set(found) == set(expected)
    for key, (total, running) in expected.items():
        assert found[key].running == pytest.approx(running) and found[key].total == pytest.approx(total)
        assert found[key].share == pytest.approx(running / total)
    # the hot group really was cut into slices
    assert out.rdd.getNumPartitions() >= 1


def test_deciles(table):
    rows = [(1, 1, 1, 1, 1, sku, float(sku)) for sku in range(1, 101)]
    df = table("store int, dept int, subdept int, class_id int, subclass_id int, sku int, v double", *rows)
    out = ranking.deciles_by_level(df, ["dept", "subdept", "class_id", "subclass_id"], ["v"]).collect()
    by_sku = {r.sku: r for r in out}
    assert by_sku[100].v_decile_dept == 1 and by_sku[90].v_decile_dept == 1 and by_sku[89].v_decile_dept == 2
    assert by_sku[9].v_decile_dept == 10 and by_sku[10].v_decile_subclass_id == 9
    ordered = [by_sku[s].v_decile_class_id for s in range(1, 101)]
    assert ordered == sorted(ordered, reverse=True) and set(ordered) == set(range(1, 11))


def test_rollups(table):
    sales = table(
        "period int, sku long, store int, amount double, units double",
        (201752, 1, 1, 5.0, 1.0), (201801, 1, 1, 6.0, 2.0), (201750, 1, 1, 9.0, 9.0),
    )
    skus = table("sku long, dept int, subdept int, class_id int, subclass_id int", (1, 1, 2, 3, 4))
    out = rollups.sales_sum_weeks(sales, skus, 201801, 2)
    assert as_set(out, "sku", "total_amount", "total_units", "class_id") == {(1, 11.0, 3.0, 3)}
    assert {"amount", "units"} <= set(rollups.as_sales(out).columns)

    stores = table("store int", (1,), (2,))
    cover = rollups.store_period_coverage(sales, stores, [201750, 201751, 201752, 201801])
    assert as_set(cover.filter("store = 2"), "period", "rows") == {
        (201750, None), (201751, None), (201752, None), (201801, None),
    }
    assert as_set(cover.filter("store = 1 and rows is not null"), "period", "rows") == {
        (201750, 1), (201752, 1), (201801, 1),
    }

    fact = table(
        "sku long, national_decile int, amount_gross double",
        (1, 1, 5.0), (2, 1, 7.0), (3, 1, 7.0), (4, 6, 9.0), (5, None, 9.0), (6, 2, 1.0),
    )
    top = rollups.top_skus_per_decile(fact)
    assert as_set(top, "decile", "place", "sku") == {(1, 1, 2), (1, 2, 3), (2, 1, 6)}


def test_one_per_key_takes_missing_values_last(table):
    rows = table("sku long, exception string", (1, "EXC"), (1, None), (2, None))
    assert as_set(picks.one_per_key(rows, ["sku"]), "sku", "exception") == {(1, "EXC"), (2, None)}


@pytest.mark.parametrize("rows", [9_000, 100_000])
def test_cuts_are_exact_in_large_groups(spark, rows):
    values = spark.range(rows).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE 'g' END AS g", "double(id * 7919 % 100003) AS v", "double(id % 13) AS w")
    shares = [i / 10 for i in range(11)]
    out = {r.g: r for r in ranking.quantile_cuts(values, ["g"], ["v", "w"], shares).collect()}
    for g in ("g", None):
        for v in ("v", "w"):
            held = sorted(r[v] for r in values.collect() if r.g == g)
            n = len(held)
            assert out[g][f"{v}_cuts"] == [held[max(1, math.ceil(round(s * n, 6))) - 1] for s in shares]


@pytest.mark.parametrize("largest", [1_000, 40])
def test_selected_cuts_are_exact_without_sorting(spark, largest):
    """Groups of 100 000 and 9 000 rows, hot values among them, against a sort."""
    rng = np.random.default_rng(8)
    held = {
        1: rng.normal(size=100_000).round(3),
        2: np.where(rng.random(9_000) < 0.4, 7.0, rng.exponential(size=9_000)),
        3: np.full(5_000, -2.5),
        None: rng.integers(0, 3, 3_000).astype(float),
        4: rng.random(30),
    }
    frames = [pd.DataFrame({"g": [g] * len(v), "v": v, "w": -v}) for g, v in held.items()]
    values = spark.createDataFrame(pd.concat(frames), "g int, v double, w double").repartition(8)
    values = values.unionByName(spark.createDataFrame([(1, None, None), (9, None, 1.0)], values.schema))
    shares = [i / 10 for i in range(11)] + [0.001, 0.999]
    out = {r.g: r for r in ranking.quantile_cuts(values, ["g"], ["v", "w"], shares, [F.count("v").alias("n")], largest).collect()}
    assert set(out) == {*held, 9} and out[9].v_cuts is None and out[9].w_cuts == [1.0] * len(shares)
    for g, v in held.items():
        assert out[g].n == len(v)
        for name, ordered in (("v", np.sort(v)), ("w", np.sort(-v))):
            ranks = [max(1, math.ceil(round(s * len(v), 6))) - 1 for s in shares]
            assert out[g][f"{name}_cuts"] == [ordered[k] for k in ranks]


@pytest.mark.parametrize("largest", [30, 300, 10**6])
def test_deciles_do_not_depend_on_what_counts_as_large(spark, largest):
    rng = np.random.default_rng(9)
    n = 3_000
    rows = pd.DataFrame({"store": rng.choice([1, 1, 1, 2], n), "dept": rng.choice(["a", "a", "b", None], n), "sub": rng.integers(0, 40, n) // 13, "v": rng.integers(0, 400, n) * 1.0, "id": range(n)})
    totals = spark.createDataFrame(rows, "store int, dept string, sub int, v double, id int")
    out = ranking.deciles_by_level(totals, ["dept", "sub"], ["v"], largest=largest).toPandas().set_index("id").sort_index()
    for keys, level in ((["store", "dept"], "dept"), (["store", "dept", "sub"], "sub")):
        for _, part in rows.groupby(keys, dropna=False):
            ordered, m = np.sort(part.v), len(part)
            cuts = [ordered[math.ceil(round(i * m / 10, 6)) - 1] for i in range(1, 10)]
            expected = [10 - sum(c <= v for c in cuts) for v in part.v]
            assert out.loc[part.id, f"v_decile_{level}"].tolist() == expected
