"""Time the main queries: one JSON line with seconds per query.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Results go to Spark's
noop sink, so every column is computed. The rollup reads a stored detail, as the daily job does; the
time to store it is its own entry. The control, a fixed scan and aggregate, is timed before and after, so that
times of two machines or days can be compared by their ratio to it ("relative").
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from harness import queries as Q  # noqa: E402
from harness.adapters import END, START  # noqa: E402
from trailmeter.constants import SNAPSHOT, STABLE  # noqa: E402
from trailmeter.plans import rollup  # noqa: E402
from trailmeter.session import build_session  # noqa: E402

DIRECT = [
    "pv_monitor",
    "monitor_m1",
    "monitor_m6",
    "semi_match",
    "monitor_merge",
    "monitor_merge_fused",
    "order_facts_stable",
    "order_facts_snapshot",
    "conversion_path",
    "conversion_path_cumulative",
    "null_skip_join",
    "user_detail",
    "user_detail_snapshot",
    "user_detail_history",
    "rollup_empty_as_account",
    "overwrite_roundtrip",
]


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return round(time.perf_counter() - begin, 3)


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def control(spark, sf_dir: str) -> float:
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    prices = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    keys = ("l_returnflag", "l_linestatus", "l_suppkey")
    return timed(lambda: compute(line.groupBy(*keys).agg(prices, F.count_distinct("l_partkey"))))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    # Start the JVM's compilers on the smallest query before anything is timed.
    compute(Q.QUERIES["json_field"](spark, sf_dir))
    control(spark, sf_dir)
    controls, times = [control(spark, sf_dir)], {}
    for name in DIRECT:
        if not only or name in only:
            times[name] = timed(lambda: compute(Q.QUERIES[name](spark, sf_dir)))
    if not only or any(name.startswith("rollup") for name in only):
        stored = []
        times["store_detail"] = timed(
            lambda: stored.append(Q.stored_detail(spark, sf_dir, STABLE, SNAPSHOT))
        )
        (detail,) = stored
        plans = {
            "rollup_levels": rollup.rollup_levels,
            "rollup_levels_plain": rollup.rollup_levels_plain,
            "rollup_path_level": rollup.rollup_paths,
            "rollup_path_level_plain": rollup.rollup_paths_plain,
            "rollup": rollup.rollup,
        }
        for name, plan in plans.items():
            times[name] = timed(lambda: compute(plan(detail, START, END, STABLE)))
    controls.append(control(spark, sf_dir))
    base = sum(controls) / 2
    result = {
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "control": controls,
        "relative": {name: round(seconds / base, 2) for name, seconds in times.items()},
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
