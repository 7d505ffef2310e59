"""What stays on disk: stage tables made on the way are removed, results read one table without a shuffle."""

import pytest
from pyspark.sql import functions as F

from registry.roles import Roles
from shelfwise import session
from shelfwise.plans.weekly_runs import weekly_runs

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, SF_DIR)


@pytest.fixture
def folder(spark, tmp_path, monkeypatch):
    """A shared folder of its own, whose stage tables are listed by name."""
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    return lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def comparable(df, columns):
    show = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(show(v) for v in row) for row in df.select(*columns).collect()), key=str)


def test_stage_tables_on_the_way_are_removed(spark, folder):
    def build():
        left = session.stage(spark.range(5), "left")
        with session.lasting():
            right = session.stage(spark.range(3, 9), "right")
        inner = session.settled(spark, "inner", lambda: session.stage(left.join(right, "id"), "deeper"))
        return inner.union(left)

    out = session.settled(spark, "out", build)
    assert folder() == ["out", "right"] and sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 3, 4, 4]


def test_parts_are_one_table(spark, folder):
    rows = spark.range(100).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 20).alias("k"))
    build = lambda nth: session.part(rows, "k", rows, nth, 4)
    assert sorted(r.id for r in session.settled(spark, "parts", build, parts=4).collect()) == list(range(100))
    # equal values of other types have other hashes: such a table takes part as a whole
    ints = rows.withColumn("k", F.col("k").cast("int"))
    assert session.part(ints, "k", rows, 1, 4).count() == 100


@pytest.fixture
def inputs(roles):
    """The tables of a run, staged before the folder is changed."""
    for name in ("stores", "skus", "store_deciles", "national_deciles", "taxes", "matrix", "promo_limits", "margins"):
        getattr(roles.cats, name)
    return roles.sales, roles.prices, roles.inventory, roles.cats


def test_weekly_runs_leave_one_table_and_no_shuffle(roles, inputs, folder):
    out = weekly_runs(*inputs)
    assert folder() == ["fact_rows"]
    assert "Exchange" not in plan_of(out) and plan_of(out).count("Scan parquet") == 1


def test_weekly_runs_in_parts(roles, inputs, monkeypatch):
    """Runs made UPC by UPC and article by article, joins shuffled, against runs made at once."""
    whole = weekly_runs(*inputs)
    monkeypatch.setattr(session, "PART_BYTES", 1 << 14)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = roles.spark.conf.get(setting)
    roles.spark.conf.set(setting, "-1")
    try:
        parts = weekly_runs(*inputs)
    finally:
        roles.spark.conf.set(setting, before)
    got = comparable(parts, whole.columns)
    assert got == comparable(whole, whole.columns) and got


def stages_of(spark, monkeypatch, name):
    """Runs a query with no table staged before; its result."""
    from registry import queries as q

    monkeypatch.setattr("registry.roles._STAGED", {})
    return q.registered()[name](spark, SF_DIR)


def test_weekly_competitor_stats_are_one_table(spark, folder, monkeypatch):
    out = stages_of(spark, monkeypatch, "weekly_competitor_stats")
    assert "Exchange" not in plan_of(out) and "weekly_stats" in folder()
    assert not {"windows", "weekly_counts", "weekly_national", "runs"} & set(folder())


ON_THE_WAY = {"sales_lines", "demand", "windows", "weekly_counts", "weekly_national", "recent_store", "asof_slices", "chosen_lines", "central"}


WEEKLY = ["price_change_by_dept", "weekly_reruns", "price_change_distribution", "rollup_flags", "rollup_nine_keys"]
OF_ONE_RUN = [
    "null_suggestion_skus", "fallback_cascade", "group_price", "top_stores", "suggested_prices_default", "group_min_price",
    "impact_by_sku", "suggestion_counts", "promo_fallback_report", "fact_table_inventory", "fact_table",
]


@pytest.mark.parametrize("names", [WEEKLY, OF_ONE_RUN])
def test_stages_of_the_fact_table_are_removed(spark, folder, monkeypatch, names):
    from registry import queries as q

    monkeypatch.setattr("registry.roles._STAGED", {})
    # the statistics of a single run are kept tables of their own
    gone = ON_THE_WAY - ({"recent_store"} if names is OF_ONE_RUN else set())
    for name in names:
        out = q.registered()[name.removesuffix("_default")](spark, SF_DIR)
        assert "fact_rows" in folder() and not gone & set(folder()), name
        if name.startswith("fact_table"):
            assert "Exchange" not in plan_of(out)


def test_the_weekly_chain_keeps_what_it_saves_alone(spark, folder, monkeypatch):
    monkeypatch.setattr("registry.queries.shared_dir", session.shared_dir)
    stages_of(spark, monkeypatch, "weekly_chain")
    assert not (ON_THE_WAY | {"fact_rows"}) & set(folder())
