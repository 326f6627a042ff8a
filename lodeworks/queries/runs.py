"""Every event read as one run of the job named by its type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators import audit
from lodeworks.queries.base import Registry, naive, table

registry = Registry()

# A run that failed has no end time.
_RUNS = """
SELECT event_type AS job_name, CAST(event_id AS VARCHAR) AS job_run_id,
       CASE WHEN value < 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
       ts AS start_time, CASE WHEN value >= 2 THEN ts + to_seconds(CAST(floor(value) AS BIGINT)) END AS end_time
FROM events"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_name"),
        F.col("event_id").cast("string").alias("job_run_id"),
        F.when(F.col("value") < 2, audit.FAILED).otherwise(audit.SUCCEEDED).alias("status"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.when(F.col("value") >= 2, F.timestamp_add("SECOND", F.floor("value"), F.col("ts").cast("timestamp"))).alias(
            "end_time"
        ),
    )


@registry.query(
    "run_metrics",
    f"SELECT *, CAST(date_diff('second', start_time, end_time) AS DOUBLE) AS duration_seconds FROM ({_RUNS})",
)
def run_metrics(spark, sf_dir):
    return naive(audit.run_metrics(_runs(spark, sf_dir)), "start_time", "end_time")


@registry.query("run_history", f"SELECT * FROM ({_RUNS}) WHERE job_name = 'purchase'")
def run_history(spark, sf_dir):
    return naive(audit.run_history(_runs(spark, sf_dir), "purchase"), "start_time", "end_time")
