"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_QUERIES (comma
list) choose what runs. Every query runs once to warm up and then BENCH_RUNS times (default 2),
of which the best counts. Times cover everything the query does, its writes included; result
rows are consumed by the no-op sink.

BENCH_TIMES (default 10; 0 for none) is how many shifted copies of events, orders and lineitem make
the larger tables on which SCALED runs once more: rows a second at either size, and their ratio.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodeworks.operators import quality  # noqa: E402
from lodeworks.queries import QUERIES  # noqa: E402
from lodeworks.storage import clear_work  # noqa: E402

HEADLINE = (
    "bronze_to_silver dq_annotate dq_valid_rows dq_invalid_rows dq_summary dq_violations merge_upsert "
    "merge_counts merge_composite_key scan_project_filter csv_roundtrip json_roundtrip parquet_roundtrip "
    "orc_roundtrip partitioned_write append_evolve table_overwrite table_copy table_merge table_partitions "
    "table_stats incremental_ingest run_metrics binary_scan table_merge_touched append_run_twice table_compact "
    "silver_retry incremental_table"
).split()


# What runs at both sizes, and the tables whose rows count for it.
SCALED = {
    "bronze_to_silver": ["events"],
    "table_merge": ["orders", "lineitem"],
    "table_merge_touched": ["orders"],
    "append_run_twice": ["orders"],
    "table_compact": ["orders"],
    "partitioned_write": ["orders"],
    "merge_upsert": ["orders", "lineitem"],
}
# Keys that each copy shifts, so that copies are new rows.
SHIFTED = {"events": ["event_id"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey"]}
SHIFT = 1_000_000_000


def enlarged(spark: SparkSession, sf_dir: str, times: int) -> str:
    """A folder with ``times`` shifted copies of the tables of SCALED."""
    folder = tempfile.mkdtemp(prefix="bench-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    for name, keys in SHIFTED.items():
        copies = spark.read.parquet(f"{sf_dir}/{name}.parquet").crossJoin(spark.range(times).withColumnRenamed("id", "__copy"))
        shifted = copies.withColumns({k: F.col(k) + F.col("__copy") * SHIFT for k in keys}).drop("__copy")
        shifted.write.parquet(f"{folder}/{name}.parquet")
    return folder


def seconds_of(spark: SparkSession, name: str, sf_dir: str, runs: int, warm: bool = False) -> float:
    """The best of ``runs``, after one more to warm up unless the query has run before."""
    taken = [0.0] if warm else []
    for _ in range(runs + (not warm)):
        start = time.perf_counter()
        consume(QUERIES[name](spark, sf_dir))
        taken.append(time.perf_counter() - start)
        clear_work(spark)
    return round(min(taken[1:]), 4)


def rates(spark: SparkSession, sf_dir: str, seconds: dict[str, float]) -> dict[str, int]:
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in SHIFTED}
    return {q: round(sum(rows[t] for t in SCALED[q]) / s) for q, s in seconds.items() if q in SCALED}


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def wide_plan_seconds(spark: SparkSession, width: int = 200) -> float:
    """Planning time of the issue annotation over many columns."""
    df = spark.range(1).select(*[F.lit(None).cast("string").alias(f"c{i}") for i in range(width)])
    start = time.perf_counter()
    quality.annotate(df)._jdf.queryExecution().executedPlan()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lodeworks-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        seconds[name] = seconds_of(spark, name, sf_dir, runs)
    wide_plan_seconds(spark)
    seconds["plan_200_columns"] = round(wide_plan_seconds(spark), 4)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    flagship = seconds.get("bronze_to_silver")
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "bronze_to_silver_rows_per_sec": round(events / flagship) if flagship else None,
    }
    times = int(os.environ.get("BENCH_TIMES", "10"))
    if times:
        large = enlarged(spark, sf_dir, times)
        at_large = {name: seconds_of(spark, name, large, 1, warm=True) for name in SCALED if name in seconds}
        small, big = rates(spark, sf_dir, seconds), rates(spark, large, at_large)
        result["scaled"] = {
            "times": times,
            "seconds": at_large,
            "rows_per_sec": {q: {"1x": small[q], f"{times}x": big[q], "ratio": round(big[q] / small[q], 2)} for q in big},
        }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
