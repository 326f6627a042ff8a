"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as one SQL identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """``value`` as one SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    """The column called exactly ``name`` (dots are not taken as struct access)."""
    return F.col(quoted(name))


def all_of(parts: Sequence[Column]) -> Column:
    return reduce(and_, parts)


def clock(run_ts: datetime | str | None) -> Column:
    """One instant as a timestamp literal.

    Text and naive datetimes are wall-clock time in the session time zone; aware
    datetimes keep their instant. ``None`` is the query's own clock.
    """
    if run_ts is None:
        return F.current_timestamp()
    text = run_ts if isinstance(run_ts, str) else run_ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def pinned_now() -> datetime:
    """The driver clock, read once per run so that every pass stamps the same value."""
    return datetime.now(timezone.utc)


def spelled(names: Sequence[str], known: Sequence[str]) -> list[str]:
    """``names``, each as ``known`` spells it, told apart the way the session's Spark does.

    Names that ``known`` lacks stay as they are.
    """
    if (SparkSession.active().conf.get("spark.sql.caseSensitive") or "").lower() == "true":
        return list(names)
    by_lower = {k.lower(): k for k in known}
    return [n if n in known else by_lower.get(n.lower(), n) for n in names]


def spelled_as(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """``df`` with the columns that ``known`` names too spelled as there."""
    names = spelled(df.columns, known)
    return df if names == df.columns else df.toDF(*names)
