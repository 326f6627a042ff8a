"""File and JDBC scans with format dispatch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lodeworks.functions.columns import named

# Formats each layer accepts.
BRONZE_SOURCES = ("csv", "json", "parquet", "orc", "jdbc")
SILVER_SOURCES = ("csv", "json", "parquet", "orc")
SMALL_SOURCES = ("csv", "json", "parquet")

# CSV text. Quotes inside quotes are doubled and blanks count. A missing value is an empty cell and empty
# text is a pair of quotes. Line breaks would split a row and make files unsplittable: `sinks.writers` puts
# a mark and a letter in their place, and readers put them back. The mark is a private-use character, which
# ordinary text doesn't hold; in text that does, it is marked itself.
MARK = "\ue000"
MARKED = (("\n", MARK + "n"), ("\r", MARK + "r"), (MARK, MARK + "e"))
CSV_DEFAULTS = {
    "header": "true",
    "escape": '"',
    "nullValue": MARK,  # never a whole cell of text; an empty cell without quotes reads as this
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def unmarked(df: DataFrame) -> DataFrame:
    """``df`` as read from CSV, with line breaks back in place."""

    def text(column: Column) -> Column:
        for plain, marked in MARKED:
            column = F.replace(column, F.lit(marked), F.lit(plain))
        return column

    strings = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: text(named(c)) for c in strings}) if strings else df


def require_format(fmt: str, allowed: tuple[str, ...], role: str) -> str:
    """Refuse an unknown format by name, before anything is read or written."""
    if fmt not in allowed:
        raise ValueError(f"Unsupported {role}: {fmt} (expected one of {', '.join(allowed)})")
    return fmt


def read_source(
    spark: SparkSession,
    fmt: str,
    path: str | list[str] | None = None,
    options: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
    allowed: tuple[str, ...] = BRONZE_SOURCES,
) -> DataFrame:
    """Scan ``path`` as ``fmt``.

    CSV takes its first row as header and infers types; inference reads the files once more,
    so pass ``schema`` for large inputs. Text written by `sinks.writers` comes back as it was,
    line breaks included, from files that Spark can split. JDBC ignores ``path`` and takes everything from
    ``options``, including ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
    for a parallel read.
    """
    require_format(fmt, allowed, "source format")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_DEFAULTS)
        if schema is None:
            reader = reader.option("inferSchema", True)
    reader = reader.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    found = reader.load() if fmt == "jdbc" else reader.load(path)
    return unmarked(found) if fmt == "csv" else found
