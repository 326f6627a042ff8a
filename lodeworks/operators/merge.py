"""Keyed merge as plain joins.

Keys match null-safely, so a NULL key matches a NULL key. Of several source rows with one
key the last by ``order_by`` updates the destination; a key the destination lacks has all of
its source rows inserted.

How it holds up at scale and with hot keys:

* the source is cut to one row per key by an aggregation, which Spark starts within each map
  task, so a key owning a third of the source ships one row per task;
* the destination's keys, needed to find the inserts, are made distinct with map-side combine
  before their shuffle;
* in every join the side that may hold a hot key is the left one and the other side holds
  one row per key, which is what AQE needs to split the hot key over several tasks.

No join is hinted: Spark broadcasts a side that its own threshold, or AQE's measure of it, allows.
Column names are told apart as the session does it; the destination's spelling is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.functions.columns import all_of, named, spelled, spelled_as
from lodeworks.sinks.writers import cluster_for

_KEY, _NEW = "__k_", "__n_"
_HIT, _COPIES, _LAST = "__hit", "__copies", "__last"


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return True


def _aligned(
    source: DataFrame, dest: DataFrame, *names: Sequence[str] | None
) -> tuple[DataFrame, list[list[str] | None]]:
    """The source and lists of names, all spelled as the destination does, or else the source."""
    source = spelled_as(source, dest.columns)
    known = [*dest.columns, *[c for c in source.columns if c not in dest.columns]]
    return source, [None if n is None else spelled(n, known) for n in names]


def _control_columns(source: DataFrame, dest: DataFrame, order_by: Sequence[str]) -> set[str]:
    """Ordering columns the destination does not have; they steer the merge and are not stored."""
    return {c for c in order_by if c not in dest.columns}


def update_set(
    source: DataFrame,
    dest: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> list[str]:
    """The columns J1 overwrites: the wanted ones that both sides have. Keys are equal as they are."""
    source, (keys, update_columns, order_by) = _aligned(source, dest, keys, update_columns, order_by)
    wanted = source.columns if update_columns is None else dict.fromkeys(update_columns)
    skip = _control_columns(source, dest, order_by) | set(keys)
    return [c for c in wanted if c in source.columns and c in dest.columns and c not in skip]


def last_per_key(
    source: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The last source row of each key. Ties fall to the greater column values, so reruns agree.

    A maximum over the ordering columns, NULL lowest, rather than a window: each map task
    keeps one row per key, and a hot key is never gathered anywhere.
    """
    ranked = [*order_by, *[c for c in columns if c not in order_by and _orderable(source.schema[c].dataType)]]
    rank = F.struct(*[named(c).alias(c) for c in ranked])
    rest = [c for c in columns if c not in ranked]
    if rest:
        last = F.max_by(F.struct(*[named(c).alias(c) for c in columns]), rank)
    else:
        last = F.max(rank)
    return (
        source.groupBy(*[named(k) for k in keys])
        .agg(last.alias(_LAST))
        .select(*[named(k) for k in keys], *[F.col(_LAST).getField(c).alias(c) for c in columns])
    )


def _only_per_key(source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key with its number of copies, for sources that promise unique keys."""
    return source.groupBy(*[named(k) for k in keys]).agg(
        *[F.any_value(named(c)).alias(c) for c in columns if c not in keys],
        F.count(F.lit(1)).alias(_COPIES),
    )


def _same_key(keys: Sequence[str]) -> Column:
    if not keys:
        raise ValueError("a merge needs at least one key column")
    return all_of([named(k).eqNullSafe(named(_KEY + k)) for k in keys])


def _replacements(
    source: DataFrame, dest: DataFrame, keys: Sequence[str], cols: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per source key: the key, the new values, and how many source rows claim it."""
    if order_by:
        picked = last_per_key(source, keys, order_by, cols).withColumn(_COPIES, F.lit(1))
    else:
        picked = _only_per_key(source, keys, cols)
    return picked.select(
        *[named(k).alias(_KEY + k) for k in keys],
        *[named(c).cast(dest.schema[c].dataType).alias(_NEW + c) for c in cols],
        _COPIES,
        F.lit(True).alias(_HIT),
    )


def update_rows(
    source: DataFrame,
    dest: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``dest`` with the update set of matching rows replaced, NULLs included.

    All destination rows of a matching key are updated. Without ``order_by`` a matching key
    that occurs more than once in the source is ambiguous and fails the query.
    """
    source, (keys, update_columns, order_by) = _aligned(source, dest, keys, update_columns, order_by)
    cols = update_set(source, dest, keys, update_columns, order_by)
    new = _replacements(source, dest, keys, cols, order_by)
    joined = dest.join(new, _same_key(keys), "left")
    twice = F.lit("ambiguous merge: a matching key occurs more than once in the source; give order_by")
    hit = F.col(_HIT).isNotNull()
    if not order_by:
        hit = F.when(F.col(_COPIES) > 1, F.raise_error(twice).cast("boolean")).otherwise(hit)
    return joined.select(
        *[
            F.when(hit, named(_NEW + c)).otherwise(named(c)).alias(c) if c in cols else named(c)
            for c in dest.columns
        ]
    )


def matching_rows(source: DataFrame, dest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``dest`` whose key ``source`` has."""
    source, (keys,) = _aligned(source, dest, keys)
    offered = source.select(*[named(k).alias(_KEY + k) for k in keys]).distinct()
    return dest.join(offered, _same_key(keys), "left_semi")


def _known_keys(dest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``dest``."""
    return dest.select(*[named(k).alias(_KEY + k) for k in keys]).distinct()


def insert_rows(
    source: DataFrame,
    dest: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Every source row whose key ``dest`` lacks, duplicates included, with all its columns."""
    source, (keys, order_by) = _aligned(source, dest, keys, order_by)
    control = _control_columns(source, dest, order_by)
    known = _known_keys(dest, keys)
    return source.join(known, _same_key(keys), "left_anti").select(
        *[
            named(c).cast(dest.schema[c].dataType).alias(c) if c in dest.columns else named(c)
            for c in source.columns
            if c not in control
        ]
    )


def merge(
    source: DataFrame,
    dest: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Updated destination rows plus inserts.

    Source columns the destination lacks widen the result (NULL for existing rows); destination
    columns the source lacks are NULL on inserts (U1). Destination types are kept.

    ``cluster_by`` names the partition columns the result will be written by; rows are then
    brought together by partition.
    """
    updated = update_rows(source, dest, keys, update_columns, order_by)
    inserted = insert_rows(source, dest, keys, order_by)
    merged = updated.unionByName(inserted, allowMissingColumns=True)
    return cluster_for(merged, spelled(cluster_by, merged.columns))


def merge_counts(source: DataFrame, dest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows_updated`` (every source row), split into ``updated`` and ``inserted``."""
    source, (keys,) = _aligned(source, dest, keys)
    known = _known_keys(dest, keys).withColumn(_HIT, F.lit(True))
    hit = F.col(_HIT).isNotNull()
    return source.join(known, _same_key(keys), "left").agg(
        F.count(F.lit(1)).alias("rows_updated"),
        F.count_if(hit).alias("updated"),
        F.count_if(~hit).alias("inserted"),
    )
