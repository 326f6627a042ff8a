"""Projection, predicate and limit over any frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from lodeworks.functions.columns import named


def scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    predicate: Column | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Filter, then project, then limit.

    The predicate may use columns that are not projected; rows where it is NULL are dropped.
    ``limit=None`` means all rows and ``limit=0`` none.
    """
    if predicate is not None:
        df = df.filter(predicate)
    if columns is not None:
        df = df.select(*[named(c) for c in columns])
    return df if limit is None else df.limit(limit)
