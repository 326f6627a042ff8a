"""Lineage columns of the bronze and silver layers.

Column names and the two date formats are fixed values shared by every reader.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.columns import clock, named

DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH-mm-ss"

Transform = Callable[[DataFrame], DataFrame]


def _stamp(layer_event: str, source_col: str, run_ts, source: str | None) -> dict[str, Column]:
    at = clock(run_ts)
    cols = {
        f"{layer_event}_timestamp": at,
        f"{layer_event}_date": F.date_format(at, DATE_FORMAT),
        f"{layer_event}_time": F.date_format(at, TIME_FORMAT),
    }
    if source is not None:
        cols[source_col] = F.lit(source)
    return cols


def stamp_bronze(df: DataFrame, source: str | None, run_ts: datetime | str | None = None) -> DataFrame:
    """Add the ``bronze_*`` columns, replacing any present. No ``source``, no path column."""
    return df.withColumns(_stamp("bronze_ingest", "bronze_source_path", run_ts, source))


def stamp_silver(df: DataFrame, source: str, run_ts: datetime | str | None = None) -> DataFrame:
    """Add the ``silver_*`` columns and normalise the ingest timestamp."""
    return normalise_ingest_timestamp(
        df.withColumns(_stamp("silver_process", "silver_source_path", run_ts, source))
    )


def normalise_ingest_timestamp(df: DataFrame, column: str = "bronze_ingest_timestamp") -> DataFrame:
    """The ingest timestamp as a timestamp. Unparsable text becomes NULL; absent is left alone."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return df
    if isinstance(kind, T.StringType):
        return df.withColumn(column, F.try_to_timestamp(named(column)))
    return df.withColumn(column, named(column).cast("timestamp"))


def apply_transforms(df: DataFrame, transforms: Iterable[Transform] = ()) -> DataFrame:
    """Run the caller's whole-frame hooks in order."""
    for step in transforms:
        df = df.transform(step)
    return df
