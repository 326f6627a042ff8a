"""Partitioned file writes with format dispatch (K1-K7, K9)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.columns import named, spelled
from lodeworks.layout import parse_partition_cols
from lodeworks.sources.readers import MARK, MARKED, require_format

SINKS = ("csv", "json", "parquet", "orc")
SMALL_SINKS = ("csv", "json", "parquet")

# Text formats cut timestamps to milliseconds unless told otherwise.
_MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
SINK_DEFAULTS: dict[str, dict[str, str]] = {
    "csv": {
        "header": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        **_MICROS,
    },
    "json": dict(_MICROS),
    "parquet": {},
    "orc": {},
}

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)


def marked(df: DataFrame, besides: Sequence[str] = ()) -> DataFrame:
    """``df`` with marks for line breaks, as `sources.readers.unmarked` expects them.

    Columns ``besides`` become folder names, which are not text of a file.
    """

    def text(column: Column) -> Column:
        for plain, mark in reversed(MARKED):
            column = F.replace(column, F.lit(plain), F.lit(mark))
        return column

    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in besides]
    return df.withColumns({c: text(named(c)) for c in strings}) if strings else df


def csv_options(columns: int) -> dict[str, str]:
    """Writer options for rows of so many cells: a row of one cell must not look like an empty line."""
    return {"nullValue": MARK, "quoteAll": "true"} if columns == 1 else {}


def cluster_for(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Bring rows of one partition folder together without creating a hot task.

    The rebalance shuffle is split by AQE wherever one partition value is large and merged
    where it is small, so a value holding a third of the rows becomes many evenly sized
    files. Without AQE nothing would split it, and the rows stay where they are: more files,
    but no task that holds a whole partition.
    """
    if not partition_cols or df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *[named(c) for c in partition_cols])


def observed_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` plus its row counter, read as ``observation.get["rows"]`` after the write.

    Apply it last, above every shuffle: metrics of the writing stage count each task once,
    while those of a shuffle's map side count again when lost output is recomputed.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_dataset(
    df: DataFrame,
    path: str,
    fmt: str,
    partition_cols: str | Iterable[str] | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "append",
    cluster: bool = True,
    allowed: tuple[str, ...] = SINKS,
) -> Observation:
    """Write ``df`` below ``path``; the returned observation holds the exact row count.

    Modes are Spark's. Reading a path and overwriting it in one plan loses data on plain
    files; tables do that safely through `operators.tables.TableStore`.
    """
    require_format(fmt, allowed, "file format")
    if fmt == "csv":
        nested = [f.name for f in df.schema if isinstance(f.dataType, _NESTED)]
        if nested:
            raise ValueError(f"Unsupported column types for csv: {', '.join(nested)}")
    parts = spelled(parse_partition_cols(partition_cols), df.columns)
    defaults = SINK_DEFAULTS[fmt]
    if fmt == "csv":
        df = marked(df, parts)
        defaults = {**defaults, **csv_options(len(df.columns) - len(parts))}
    if cluster:
        df = cluster_for(df, parts)
    df, seen = observed_rows(df)
    writer = df.write.format(fmt).options(**{**defaults, **(options or {})}).mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)
    return seen
