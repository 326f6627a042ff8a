"""Frames and text rules that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.columns import named
from lodeworks.storage import work_folder

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(column: str, by: int) -> Column:
    """crc32 of an id written as text, modulo ``by``."""
    return F.crc32(F.col(column).cast("string")) % by


def boxed(docs: DataFrame) -> Column:
    """A whole row as one column, ``row``, beside which any name is free; `unboxed` takes it apart."""
    return F.struct(*[named(c) for c in docs.columns]).alias("row")


def unboxed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns of ``row``, whatever their names."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in names])


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, kept in the shared work folder, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.option("compression", "none").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema):
    """``df`` through ``run`` in Arrow batches, with this package importable where the driver's folder is seen.

    Machines that don't see it need the package installed or sent with ``--py-files``.
    """
    root, env = str(Path(__file__).parents[2]), df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df.mapInArrow(run, schema)
