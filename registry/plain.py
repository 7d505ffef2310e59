"""Plain formulations to measure against: best rows by aggregate and self join, medians
snapped to an observed price by another join, each week on its own, broadcast joins off.

``python -m registry.plain [sf_dir]`` prints seconds for these and for the library.
"""

from __future__ import annotations

import json
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.roles import Roles
from shelfwise.functions.prices import ending_price
from shelfwise.operators.matching import OBSERVATION, matrix_prices
from shelfwise.plans import fact_table as fact_plan
from shelfwise.plans.competitor_stats import look_back


def _with_observed_median(base: DataFrame, keys: list[str], aggs: list) -> DataFrame:
    first = base.groupBy(*keys).agg(*aggs, F.percentile_approx("comp_price", 0.5).alias("_m"))
    snapped = (
        base.join(first.select(*keys, "_m"), keys)
        .filter(F.col("comp_price") <= F.col("_m"))
        .groupBy(*keys)
        .agg(F.max("comp_price").alias("median"))
    )
    return first.join(snapped, keys).drop("_m")


def _mode(base: DataFrame, keys: list[str]) -> DataFrame:
    counts = (
        base.withColumn("_e", ending_price(F.col("comp_price"))).groupBy(*keys, "_e").agg(F.count("_e").alias("_n"))
    )
    most = counts.groupBy(*keys).agg(F.max("_n").alias("_n"))
    return counts.join(most, [*keys, "_n"]).groupBy(*keys).agg(F.first("_n").alias("freq"), F.min("_e").alias("mode"))


def _latest(base: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(base.groupBy(*keys).agg(F.max("period").alias("period")), [*keys, "period"])


def _named(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in keys))


def competitor_stats(r: Roles) -> DataFrame:
    base = matrix_prices(look_back(r.prices, r.run_period, 0, r.look_back), r.cats.matrix)
    two = [F.avg("comp_price").alias("avg"), F.stddev("comp_price").alias("std")]

    def national(period: int, prefix: str) -> DataFrame:
        week = base.filter(F.col("period") == period)
        return _named(_with_observed_median(week, ["upc"], two).join(_mode(week, ["upc"]), "upc"), ["upc"], prefix)

    more = [F.min("comp_price").alias("min"), F.max("comp_price").alias("max")]
    more += [F.percentile_approx("comp_price", p / 10).alias(f"p{p}0") for p in (1, 2, 8, 9)]
    history = _named(_with_observed_median(base, OBSERVATION, [*two, *more]), OBSERVATION, "hist")
    weekly = ["upc", "period"]
    newest = _latest(_with_observed_median(base, weekly, two[:1]).join(_mode(base, weekly), weekly), ["upc"])
    recent = _named(_latest(base, OBSERVATION), OBSERVATION, "recent")
    return (
        history.join(recent, OBSERVATION, "left")
        .join(national(r.run_period - 2, "market"), "upc", "left")
        .join(national(r.run_period, "market_now"), "upc", "left")
        .join(_named(newest, ["upc"], "recent_market"), "upc", "left")
    )


def priority_pick(r: Roles) -> DataFrame:
    hierarchy = r.cats.skus.select("sku", "upc", *fact_plan.HIERARCHY)
    rows = fact_plan.sales_lines(r.total_sales, hierarchy).join(r.cats.matrix, ["store", "dept", "subdept"])
    then = fact_plan.week_prices(r.prices, r.run_period - 2, "_then")
    now = fact_plan.week_prices(r.prices, r.run_period, "_now")
    recent = _latest(look_back(r.prices, r.run_period, 0, r.look_back), OBSERVATION).withColumnRenamed(
        "comp_price", "_recent"
    )
    for prices in (then, now, recent.drop("period")):
        rows = rows.join(prices, OBSERVATION, "left")
    for name, cost in (("_then", 10_000), ("_now", 1_000), ("_recent", 100)):
        rows = rows.withColumn("priority", F.col("priority") + F.when(F.col(name).isNull(), cost).otherwise(0))
    best = rows.groupBy("store", "upc").agg(F.min("priority").alias("priority"))
    return rows.join(best, ["store", "upc", "priority"]).select(
        "sku", "upc", "store", "comp_store", "comp_source", "priority", ending_price(F.col("_recent")).alias("price")
    )


def latest_price_per_store(r: Roles) -> DataFrame:
    return _latest(r.prices, OBSERVATION)


def main() -> None:
    from bench import session
    from registry.queries import registered

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session("8")
    roles = Roles(spark, sf_dir)
    roles.stats
    ours = registered()
    out: dict[str, dict[str, float]] = {}
    for fn in (competitor_stats, priority_pick, latest_price_per_store):
        name = fn.__name__
        for kind, build in (("library", lambda: ours[name](spark, sf_dir)), ("plain", lambda: fn(roles))):
            for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
                spark.conf.set(key, "-1") if kind == "plain" else spark.conf.unset(key)
            times = []
            for _ in range(4):
                begin = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - begin)
            out.setdefault(name, {})[kind] = round(statistics.median(times[1:]), 2)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
