"""Seconds per headline query, as one JSON line.

Every query is written to the no-op sink, once to warm up and then three times; the median
counts. Stage tables a query starts from are made before, and timed as ``stage:*``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from registry.queries import registered
from registry.roles import Roles

HEADLINE = """competitor_stats fact_table suggested_prices price_impact priority_pick
    national_price_stats store_price_history latest_price_per_store sales_sum_weeks
    sales_price_stats_by_format group_price desc_items rollup_nine_keys deciles_by_level
    cumulative_share top_stores price_rounding""".split()


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # the plans are wide; keep their compiled classes between runs
        .config("spark.sql.codegen.cache.maxEntries", "4000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}

    roles = Roles(spark, sf_dir)
    for name in ("prices", "sales", "total_sales", "inventory", "stats", "fact", "suggested", "weekly_fact"):
        times[f"stage:{name}"] = round(seconds(lambda: getattr(roles, name)), 3)

    queries = registered()
    for name in wanted:
        run = lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        times[name] = round(statistics.median(seconds(run) for _ in range(3)), 3)

    total = round(sum(times[name] for name in wanted), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
