"""Run records and what is asked of them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.columns import pinned_now
from lodeworks.storage import Folders

RUNNING, SUCCEEDED, FAILED = "RUNNING", "SUCCEEDED", "FAILED"

RUN_SCHEMA = (
    T.StructType()
    .add("job_name", "string")
    .add("job_run_id", "string")
    .add("status", "string")
    .add("start_time", "timestamp")
    .add("end_time", "timestamp")
    .add("attempt", "integer")
    .add("capacity", "integer")
    .add("params", T.MapType(T.StringType(), T.StringType()))
    .add("rows_read", "long")
    .add("column_count", "integer")
    .add("rows_written", "long")
    .add("rows_valid", "long")
    .add("rows_invalid", "long")
    .add("error_type", "string")
    .add("error_message", "string")
)


@dataclass(frozen=True)
class RunAudit:
    """One job run. Counters are None where the run did not get that far or does not apply.

    ``capacity`` is the number of tasks the cluster could run at once when the job started.
    """

    job_name: str
    status: str = RUNNING
    job_run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    start_time: datetime = field(default_factory=pinned_now)
    end_time: datetime | None = None
    attempt: int = 1
    capacity: int | None = None
    params: dict[str, str] = field(default_factory=dict)
    rows_read: int | None = None
    column_count: int | None = None
    rows_written: int | None = None
    rows_valid: int | None = None
    rows_invalid: int | None = None
    error_type: str | None = None
    error_message: str | None = None

    def succeeded(self, **counters) -> RunAudit:
        return replace(self, status=SUCCEEDED, end_time=pinned_now(), **counters)

    def failed(self, error: BaseException) -> RunAudit:
        return replace(
            self, status=FAILED, end_time=pinned_now(), error_type=type(error).__name__, error_message=str(error)
        )


def _literal(value) -> Column:
    if isinstance(value, dict):
        return F.create_map(*[F.lit(part) for pair in value.items() for part in pair])
    return F.lit(value)


class AuditLog:
    """Append-only run table. Each run writes its own folder, so jobs may finish together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def append(self, run: RunAudit) -> None:
        one = self.spark.range(0, 1, 1, 1)
        row = one.select(*[_literal(getattr(run, f.name)).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA])
        row.write.mode("append").parquet(f"{self.path}/run-{run.job_run_id}")

    def runs(self) -> DataFrame:
        if not Folders(self.spark).exists(self.path):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).option("recursiveFileLookup", True).parquet(self.path)


def run_metrics(runs: DataFrame) -> DataFrame:
    """A5: every run with ``duration_seconds``, NULL unless it has both a start and an end."""
    return runs.withColumn(
        "duration_seconds",
        F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / F.lit(1_000_000.0),
    )


def run_history(runs: DataFrame, job_name: str) -> DataFrame:
    """All runs of one job."""
    return runs.filter(F.col("job_name") == job_name)
