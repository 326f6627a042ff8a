"""Sample rows in the shape the ingest jobs are tried out with."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.columns import clock, named


def sample_columns(ids: DataFrame, id_col: str, run_ts: datetime | str | None = None) -> DataFrame:
    """One sample row per id: ``id, name, value, date, timestamp``."""
    i, at = named(id_col), clock(run_ts)
    return ids.select(
        i.alias("id"),
        F.concat(F.lit("Name "), i.cast("string")).alias("name"),
        (i * 10).alias("value"),
        at.cast("date").alias("date"),
        at.alias("timestamp"),
    )


def sample_rows(spark: SparkSession, size: int = 1000, run_ts: datetime | str | None = None) -> DataFrame:
    """``size`` sample rows with ids 1..size."""
    return sample_columns(spark.range(1, size + 1), "id", run_ts)
