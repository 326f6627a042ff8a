"""File inventories as DataFrames.

Spark's file sources pass over hidden names (``_*``, ``.*``) and files of length zero, which are often markers that
something waits for. So inventories come from the file system's own listing: folders are listed many at a time,
each in a few calls whatever the number of its files, and no file is opened. Bodies are read by tasks through the
``binaryFile`` source; empty files have none to read, and hidden ones are copied to the work folder under names
that Spark reads.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.storage import Folders, work_folder

_LISTED = "path string, relative_path string, length long, modificationTime timestamp"


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """Every file below ``root`` whose name ends with ``suffix``."""
    folders = Folders(spark)
    base = len(folders.qualified(root).rstrip("/")) + 1
    found = [f for f in chain.from_iterable(folders.walk(root)) if f[0].endswith(suffix)]
    if not found:
        return spark.createDataFrame([], _LISTED)
    paths, lengths, times = zip(*found)
    stamps = pa.array(times, pa.int64()).cast(pa.timestamp("ms", "UTC")).cast(pa.timestamp("us", "UTC"))
    columns = [pa.array(paths), pa.array([p[base:] for p in paths]), pa.array(lengths, pa.int64()), stamps]
    return spark.createDataFrame(pa.Table.from_arrays(columns, _LISTED.replace(",", "").split()[::2]))


def _hidden(path) -> F.Column:
    return F.exists(F.split(path, "/"), lambda part: F.substring(part, 1, 1).isin("_", "."))


def list_prefixes(spark: SparkSession, root: str) -> DataFrame:
    """The immediate child folders of ``root``, from a listing of this one level."""
    return spark.createDataFrame([(c,) for c in Folders(spark).children(root)], "prefix string")


def _bodies(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return found.load(root).select("path", "length", "content")


def read_objects(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """File bodies as bytes, one row per file, empty and hidden ones included."""
    base = len(Folders(spark).qualified(root).rstrip("/")) + 1
    relative = F.substring("path", F.lit(base + 1), F.length("path"))  # by length, so no character needs escaping
    out = _bodies(spark, root, suffix).filter((F.col("length") > 0) & ~_hidden(relative))
    out = out.select("path", relative.alias("relative_path"), "length", "content")
    listed = list_files(spark, root, suffix)
    empty = listed.filter("length = 0").select("path", "relative_path", "length", F.lit(b"").alias("content"))
    named = listed.filter((F.col("length") > 0) & _hidden(F.col("relative_path"))).select("path", "relative_path").collect()
    out = out.unionByName(empty)
    if not named:
        return out
    copies = work_folder(spark, "hidden")
    Folders(spark).make(copies)
    Folders(spark).copy_files([(r["path"], f"{copies}/{i}") for i, r in enumerate(named)])
    names = spark.createDataFrame([(str(i), *r) for i, r in enumerate(named)], "name string, path string, relative_path string")
    copied = _bodies(spark, copies).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "length", "content")
    return out.unionByName(copied.join(names, "name").drop("name"))


def check_expected(spark: SparkSession, root: str, expected: DataFrame, key: str = "relative_path") -> DataFrame:
    """``expected`` keys with ``found`` telling whether that file exists below ``root``."""
    present = list_files(spark, root).select(
        F.col("relative_path").alias("__present"), F.lit(True).alias("__found")
    )
    return expected.join(present, F.col(key) == F.col("__present"), "left").select(
        *expected.columns, F.coalesce("__found", F.lit(False)).alias("found")
    )


def file_rollup(spark: SparkSession, root: str) -> DataFrame:
    """A4: one row with ``size_bytes`` and ``file_count`` of the files below ``root``."""
    return list_files(spark, root).agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"), F.count(F.lit(1)).alias("file_count")
    )


def check_outputs(spark: SparkSession, outputs: Sequence[tuple[str, str]]) -> DataFrame:
    """Per ``(label, folder)`` the file count, bytes and whether nothing has landed there."""
    folders = Folders(spark)
    out = spark.createDataFrame([], "output string, file_count long, size_bytes long, is_empty boolean")
    none = spark.createDataFrame([(0, 0)], "size_bytes long, file_count long")
    for label, folder in outputs:
        found = file_rollup(spark, folder) if folders.exists(folder) else none
        is_empty = (F.col("file_count") == 0).alias("is_empty")
        out = out.unionByName(found.select(F.lit(label).alias("output"), "file_count", "size_bytes", is_empty))
    return out
