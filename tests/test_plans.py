"""What the physical plans look like: pushdown, early reduction, skew handling."""

import re

import pytest
from pyspark.sql import functions as F

from registry.roles import Roles
from shelfwise.operators import picks, pricestats, ranking, rollups
from shelfwise.operators.joins import left_join_spread
from shelfwise.plans import competitor_stats as comp_plan
from shelfwise.plans import fact_table as fact_plan

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def roles(spark):
    return Roles(spark, SF_DIR)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan_of(df)))


def test_week_filter_and_columns_reach_the_scan(roles):
    plan = plan_of(fact_plan.week_prices(roles.prices, 200144, "p"))
    assert "EqualTo(period,200144)" in plan and "Exchange" not in plan
    plan = plan_of(comp_plan.competitor_upcs(roles.prices, 200144, 52))
    assert "GreaterThanOrEqual(period,200045)" in plan
    assert re.search(r"ReadSchema: struct<period:int,upc:bigint>", plan)


def test_all_statistics_of_a_key_take_two_shuffles(roles):
    stats = pricestats.price_stats(
        roles.prices, ["upc"], "comp_price", "x",
        ("avg", "std", "min", "max", "median", "mode", "mode_freq"), {"p10": 0.1, "p90": 0.9},
    )
    assert shuffles(stats) == 2
    # prices are counted before the first of them
    assert plan_of(stats).count("partial_count(1)") == 1


def test_top_rows_are_reduced_before_the_shuffle(table):
    fact = table("sku long, national_decile int, amount_gross double", (1, 1, 1.0))
    assert "WindowGroupLimit" in plan_of(rollups.top_skus_per_decile(fact))


def test_best_store_is_reduced_before_the_shuffle(roles):
    from registry.queries import registered

    assert "WindowGroupLimit" in plan_of(registered()["priority_pick"](roles.spark, SF_DIR))


def test_hot_key_of_a_join_is_split(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # a third of the rows is one key, all of them in its latest week
        rows = spark.range(0, 90_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("upc"),
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 5).alias("period"),
            F.col("id").alias("v"),
        )
        df = picks.latest_rows(rows, ["upc"], "period")
        execution = df._jdf.queryExecution()
        assert execution.toRdd().count() == 90_000
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_group_is_sliced(spark, table):
    rows = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("g"), F.col("id"), F.lit(2.0).alias("v"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        out = ranking.cumulative_share(rows, ["g"], "v", ["id"])
        assert re.search(r"windowspecdefinition\(_at#\d+, v#", plan_of(out)), "running totals per slice"
        top = out.agg(F.max("running"), F.max("share"), F.count_distinct("running")).first()
        assert tuple(top) == (40_000.0, 1.0, 20_000)
    finally:
        spark.conf.set(setting, "true")


def test_deciles_of_all_levels_share_one_shuffle(roles):
    totals = rollups.sales_sum_weeks(roles.sales, roles.cats.skus, 200144, 400)
    levels = ["dept", "subdept", "class_id", "subclass_id"]
    one, all_levels = (ranking.deciles_by_level(totals, levels[:n], ["total_amount", "total_units"]) for n in (1, 4))
    assert shuffles(all_levels) == shuffles(one) == shuffles(totals) + 1
    assert "rangepartitioning" not in plan_of(all_levels) and plan_of(all_levels).count("Scan parquet") == plan_of(totals).count("Scan parquet")


def test_change_distribution_reads_its_table_once(roles):
    df = rollups.price_change_distribution(roles.weekly_fact, ["period", "dept"])
    assert plan_of(df).count("Scan parquet") == 1 and shuffles(df) == 1


def test_cuts_of_large_groups_shuffle_only_what_is_inside_the_brackets(spark):
    rows = spark.range(0, 50_000, 1, 8).select(F.lit(1).alias("g"), (F.xxhash64("id") / 1e9).alias("v"))
    plan = plan_of(ranking.quantile_cuts(rows, ["g"], ["v"], [0.5], largest=1000))
    assert "rangepartitioning" not in plan and "_value" in plan[plan.index("Window") :]


def test_nine_keys_count_distinct_on_reduced_rows(roles):
    plan = plan_of(rollups.rollup_nine_keys(roles.fact))
    assert "partial_sum(amount" in plan[plan.index("Expand") :], "sums by article and store come before the expansion"


def test_missing_groups_are_dealt_over_all_tasks(spark):
    """Nine rows of ten have no group; none of the tasks of the join gets more than a few of them."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    before = {k: spark.conf.get(k, None) for k in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        rows = spark.range(0, 20_000, 1, 4).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 70).alias("g"))
        right = spark.range(0, 70, 10).select(F.col("id").alias("g"), (F.col("id") * 2).alias("v"))
        out = left_join_spread(rows, right, ["g"], ["id"])
        assert sorted(out.columns) == ["g", "id", "v"] and "_spread" in plan_of(out)
        assert out.filter("NOT v <=> g * 2").count() == 0 and out.count() == 20_000
        by_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(by_task) == 8 and max(by_task) < 2 * 20_000 / 8
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
