"""Tables on storage, registered in the session's catalog as they are used.

The folder of a table is its truth, whatever session looks at it::

    <silver_root>/processed/<table>/snapshot-<time>-<id>/   a complete set of rows
    <silver_root>/processed/<table>/append-<time>-<id>/     rows that were added
    <silver_root>/processed/<table>/delta-<time>-<id>/      partitions that replace those of all layers before
    <silver_root>/processed/<table>/_metadata/v<number>.json   schema, partition columns, layers in order,
                                                               and files of layers that count no longer
    <silver_root>/processed/<table>/ranges-<time>-<id>/     the least and greatest values that files of layers hold

Every write puts its rows into a folder of its own, a layer, that nothing names yet; then a version that lists it
appears by one rename. The version with the highest number counts. So a failure at any moment leaves the version
before, a write that is tried again can't double rows, and every session and every reader sees all of a change
or nothing. A version follows the one it was computed from: where another writer came between, appends are put on
top of that, and all else is refused. Folders that aren't used any more stay for readers that still use them until `vacuum`.

For Spark a table is a catalog entry with one more partition column, which holds the layer. A layer's partitions
are added to it as they lie; the table's name is a view of the layers of the current version. A DataFrame
read earlier keeps the layers, and the files, it was made from.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone
from functools import cached_property
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructField, StructType

from lodeworks.errors import DataError, LakeError
from lodeworks.functions.columns import all_of, named, quoted, spelled, spelled_as, sql_text
from lodeworks.layout import LakeLayout, parse_partition_cols
from lodeworks.operators.merge import matching_rows, merge, update_set
from lodeworks.operators.scans import scan
from lodeworks.sinks.writers import cluster_for, observed_rows
from lodeworks.storage import Folders


_ENTRY = "__v"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Kinds of layers, by how their folders are called.
_SNAPSHOT, _APPEND, _DELTA, _RANGES = "snapshot", "append", "delta", "ranges"
#: Runs that a version remembers, and versions whose files are kept, the current one included.
RUNS, VERSIONS = 1000, 100
#: Partitions that one statement adds.
_ADDED = 500


@dataclass(frozen=True)
class _Version:
    """One state of a table, as its metadata file has it. ``entry`` changes with all but appends.

    ``runs`` has the rows of writes that were given a run id, ``dropped`` the files that a merge has
    replaced inside layers that stay, as `_file` says them. ``ranges`` has what `index` has written: a folder
    and the columns and layers it covers.
    """

    number: int
    entry: str
    layers: tuple[str, ...]
    schema: StructType
    partition_columns: tuple[str, ...]
    runs: dict[str, int] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()
    ranges: tuple[dict, ...] = ()

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": json.loads(self.schema.json())})

    @classmethod
    def of(cls, text: str) -> _Version:
        found = json.loads(text)
        if "snapshot" in found:  # as versions were written before appends had layers
            found["layers"] = [found.pop("snapshot"), *found.pop("deltas")]
        lists = {k: tuple(found.get(k, ())) for k in ("layers", "partition_columns", "dropped", "ranges")}
        return cls(**{**found, **lists, "schema": StructType.fromJson(found["schema"])})

    @property
    def layer_column(self) -> str:
        """A name that no column has."""
        name, have = "__layer", {n.lower() for n in self.schema.names}
        while name in have:
            name += "_"
        return name


@dataclass(frozen=True)
class MergeResult:
    """J4 for a stored merge; ``rows_updated`` counts every source row."""

    path: str
    rows_updated: int
    updated: int
    inserted: int


@dataclass(frozen=True)
class Written:
    """What an earlier write of the same run has written; looks like an observation."""

    rows: int

    @cached_property
    def get(self) -> dict[str, int]:
        return {"rows": self.rows}


def _file(version: _Version) -> str:
    """SQL for the file that a row comes from: its layer, partition folders and name."""
    return f"substring_index(_metadata.file_path, '/', {-2 - len(version.partition_columns)})"


def _column_or_null(df: DataFrame, field: StructField) -> Column:
    if field.name in df.columns:
        return named(field.name)
    return F.lit(None).cast(field.dataType).alias(field.name)


def _stored_as(df: DataFrame, field: StructField) -> Column:
    """The column of ``df`` as the table stores it: null if it lacks it, cast where values can't change their meaning."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    have, want = df.schema[field.name].dataType, field.dataType
    if have == want:
        return named(field.name)
    text, logic = StringType, BooleanType
    if (isinstance(have, text) and not isinstance(want, text)) or isinstance(want, logic) != isinstance(have, logic) and (
        isinstance(want, (logic, NumericType)) and isinstance(have, (logic, NumericType))
    ):
        raise DataError(f"Column {field.name} is {want.simpleString()}, not {have.simpleString()}", source="tables")
    return named(field.name).cast(want).alias(field.name)


class TableStore:
    """The tables of one layout."""

    def __init__(self, spark: SparkSession, layout: LakeLayout):
        self.spark = spark
        self.layout = layout
        self.folders = Folders(spark)
        #: The version last read of each table, and the one its catalog entry was last brought up to.
        self._read: dict[str, tuple[tuple, _Version]] = {}
        self._known: dict[str, _Version] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(layout.database)} LOCATION {sql_text(layout.database_path)}")

    # -- names and metadata ------------------------------------------------------------

    def _id(self, table: str) -> str:
        return f"{quoted(self.layout.database)}.{quoted(table)}"

    @contextmanager
    def _reporting(self, table: str, action: str) -> Iterator[None]:
        try:
            yield
        except PySparkException as e:
            raise DataError(f"Failed to {action} table {table}: {e}", source="tables", table=table) from e

    def _require(self, table: str, role: str) -> None:
        if not self.exists(table):
            raise DataError(f"{role} table {table} does not exist", source="tables", table=table)

    def _in_catalog(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._id(name))

    def _stored(self, table: str) -> _Version | None:
        """The current version on storage, by one listing."""
        home = self.layout.metadata_path(table)
        found = [f for f in self.folders.listing(home) if not f[1] and f[0].startswith("v") and f[0].endswith(".json")]
        if not found:
            return None
        last = max(found)  # with its size and time, as a table may be dropped and made anew by someone else
        if self._read.get(table, (None, None))[0] != last:
            self._read[table] = last, _Version.of(self.folders.read_text(f"{home}/{last[0]}"))
        return self._read[table][1]

    def _entry(self, table: str, version: _Version) -> str:
        return f"{table}{_ENTRY}{version.entry}"

    def _attach(self, table: str, version: _Version) -> str:
        """The catalog entry of ``version``, made or brought up to date if need be, and the view that shows it."""
        entry, known = self._entry(table, version), self._known.get(table)
        if known == version and self._in_catalog(entry):
            return entry
        with self._reporting(table, "attach"):
            registered: tuple[str, ...] = ()
            if self._in_catalog(entry):
                have = self.spark.table(self._id(entry)).columns
                fresh = [f for f in version.schema if f.name not in have]
                if fresh:
                    self.spark.sql(f"ALTER TABLE {self._id(entry)} ADD COLUMNS ({StructType(fresh).toDDL()})")
                if known is not None and known.entry == version.entry:
                    registered = known.layers
            else:
                data = [f for f in version.schema if f.name not in version.partition_columns]
                parts = [version.schema[p] for p in version.partition_columns]
                columns = StructType([*data, StructField(version.layer_column, StringType()), *parts])
                names = ", ".join(map(quoted, (version.layer_column, *version.partition_columns)))
                self.spark.sql(
                    f"CREATE TABLE {self._id(entry)} ({columns.toDDL()}) USING {self.layout.table_format} "
                    f"PARTITIONED BY ({names}) LOCATION {sql_text(self.layout.table_path(table))}"
                )
            self._register(table, version, entry, [x for x in version.layers if x not in registered])
            self.spark.catalog.refreshTable(self._id(entry))
            self._show(table, version)
        self._known[table] = version
        return entry

    def _register(self, table: str, version: _Version, entry: str, layers: Sequence[str]) -> None:
        """Add the partitions of layers to the entry, but for those that a later delta replaces."""
        depth, home, specs = len(version.partition_columns), self.layout.table_path(table), []
        hidden: set[str] = set()
        for layer in reversed(version.layers):
            if layer in layers or (layer.startswith(_DELTA) and layers):
                found = self._partition_folders(f"{home}/{layer}", depth)
                if layer in layers:
                    specs += [(layer, f) for f in found if f not in hidden]
                if layer.startswith(_DELTA):
                    hidden |= set(found)
        column = quoted(version.layer_column)
        for at in range(0, len(specs), _ADDED):
            added = " ".join(
                f"PARTITION ({column} = {sql_text(layer)}{', ' + _spec(f) if f else ''}) "
                f"LOCATION {sql_text(f'{home}/{layer}/{f}'.rstrip('/'))}"
                for layer, f in specs[at : at + _ADDED]
            )
            self.spark.sql(f"ALTER TABLE {self._id(entry)} ADD IF NOT EXISTS {added}")

    def _partition_folders(self, folder: str, depth: int) -> list[str]:
        """The folders of partitions below a layer, such as ``a=1/b=x``."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{c}".lstrip("/") for f in found for c in self.folders.children(f"{folder}/{f}") if "=" in c]
        return found

    def _is_foreign(self, table: str) -> bool:
        """Whether the catalog has a table of this name itself, not a view that this class has made."""
        return any(t.name == table.lower() and not t.isTemporary and t.tableType != "VIEW" for t in self._listed())

    def _show(self, table: str, version: _Version) -> None:
        """Make the table's name a view of a version. Files of a table the catalog had by this name stay."""
        if self._is_foreign(table):
            self.spark.sql(f"DROP TABLE {self._id(table)}")
        columns = ", ".join(map(quoted, version.schema.names))
        layers = ", ".join(map(sql_text, version.layers))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._id(table)} AS SELECT {columns} FROM {self._id(self._entry(table, version))} "
            f"WHERE {quoted(version.layer_column)} IN ({layers})"
            + (f" AND {_file(version)} NOT IN ({', '.join(map(sql_text, version.dropped))})" if version.dropped else "")
        )

    def _rows(self, table: str, version: _Version | None) -> DataFrame:
        """All rows of a version; an unknown table fails as Spark reports it."""
        if version is None:
            return self.spark.table(self._id(table))
        return self._of_layers(table, version, version.layers)

    def _of_layers(
        self, table: str, version: _Version, layers: Sequence[str], hidden: dict[str, str] | None = None
    ) -> DataFrame:
        """The rows that some layers have in a version. Spark leaves out the other layers, and dropped files, unread."""
        rows = self.spark.table(self._id(self._attach(table, version))).filter(named(version.layer_column).isin(*layers))
        if version.dropped:
            rows = rows.filter(~F.expr(_file(version)).isin(*version.dropped))
        more = [F.expr(sql).alias(name) for name, sql in (hidden or {}).items()]
        return rows.select(*[named(c) for c in version.schema.names], *more)

    def _commit(self, table: str, base: _Version | None, version: _Version) -> _Version:
        """Make ``version`` the one that follows ``base``; from here on it is the table."""
        version = replace(version, number=base.number + 1 if base else 1)
        home = self.layout.metadata_path(table)
        self.folders.write_text(f"{home}/{_file_name(version.number)}", version.to_json())
        if version.number > VERSIONS:
            self.folders.remove(f"{home}/{_file_name(version.number - VERSIONS)}")
        self._attach(table, version)
        return version

    def _commit_alone(self, table: str, base: _Version | None, version: _Version) -> _Version:
        """`_commit`, refused where another writer has changed the table since ``base``."""
        try:
            if (now := self._stored(table)) != base and (now and now.number) != (base and base.number):
                raise LakeError("a newer version is there")
            return self._commit(table, base, version)
        except LakeError as e:
            if isinstance(e, DataError):
                raise
            raise DataError(
                f"Table {table} was changed by another writer; nothing was written", source="tables", table=table
            ) from e

    def exists(self, table: str) -> bool:
        """On storage, or known to the catalog alone."""
        return self._stored(table) is not None or self._is_foreign(table)

    def _listed(self):
        return self.spark.catalog.listTables(quoted(self.layout.database))

    def names(self) -> list[str]:
        """The names of all tables of the layout, whichever session wrote them; only metadata is looked at."""
        home = self.layout.database_path.rstrip("/")
        stored = {t for t in self.folders.children(home) if self._stored(t) is not None}
        lower = {t.lower() for t in stored}
        listed = [t.name for t in self._listed() if not t.isTemporary and t.tableType != "VIEW" and _ENTRY not in t.name]
        return sorted({*stored, *[t for t in listed if t not in lower]})

    def listing(self) -> DataFrame:
        """T6 as rows (U2: names are distinct)."""
        return self.spark.createDataFrame([(n,) for n in self.names()], "table_name string")

    def _schema(self, table: str, version: _Version | None) -> StructType:
        return version.schema if version else self.spark.table(self._id(table)).schema

    def schema(self, table: str) -> StructType:
        """T3."""
        with self._reporting(table, "get the schema of"):
            return self._schema(table, self._stored(table))

    def schema_rows(self, table: str) -> DataFrame:
        """T3 as rows: ``position, name, type, nullable, is_partition``."""
        with self._reporting(table, "get the schema of"):
            version = self._stored(table)
            schema, parts = self._schema(table, version), set(self._parts(table, version))
        rows = [
            (i, f.name, f.dataType.simpleString(), f.nullable, f.name in parts) for i, f in enumerate(schema.fields, start=1)
        ]
        return self.spark.createDataFrame(
            rows, "position int, name string, type string, nullable boolean, is_partition boolean"
        )

    def _parts(self, table: str, version: _Version | None) -> list[str]:
        if version is not None:
            return list(version.partition_columns)
        return [c.name for c in self.spark.catalog.listColumns(self._id(table)) if c.isPartition]

    def partition_columns(self, table: str) -> list[str]:
        with self._reporting(table, "get the partition columns of"):
            return self._parts(table, self._stored(table))

    def location(self, table: str) -> str:
        """The folder of the current snapshot."""
        with self._reporting(table, "locate"):
            version = self._stored(table)
            if version is not None:
                return f"{self.layout.table_path(table)}/{version.layers[0]}"
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._id(table)}")
            # A column may have this name too; the table's own details come last.
            return described.filter("col_name = 'Location'").collect()[-1]["data_type"]

    def layers(self, table: str) -> list[str]:
        """The folders that the current version is made of, in order."""
        version = self._stored(table)
        return list(version.layers) if version else []

    # -- reading -----------------------------------------------------------------------

    def read(
        self,
        table: str,
        columns: Sequence[str] | None = None,
        predicate: Column | str | None = None,
        limit: int | None = None,
        between: dict[str, tuple] | None = None,
    ) -> DataFrame:
        """T5, S12.

        ``between`` names columns with a least and a greatest value, None for an open end; rows outside, and
        nulls, are left out as by a predicate. Files that `index` knows to hold no such row are not opened.
        """
        with self._reporting(table, "read from"):
            version = self._stored(table)
            rows = self._rows(table, version)
            if between:
                names = spelled(list(between), rows.columns)
                wanted = dict(zip(names, between.values()))
                files = self._holding(table, version, wanted) if version else None
                rows = rows.filter(all_of([_within(named(c), named(c), *ends) for c, ends in wanted.items()]))
                rows = rows if files is None else rows.filter(files)
            return scan(rows, columns, predicate, limit)

    def index(self, table: str, columns: Sequence[str]) -> int:
        """note the least and greatest values that each file holds of ``columns``; returns the files looked at.

        Only layers that aren't covered yet are read, and of them these columns. What `read` takes ``between``
        two values then leaves out whole files, which pays where rows lie in an order (`compact` with
        ``order_by``). Files of later writes are read by all until the next call. A row per file is kept, in a
        folder that the version names.
        """
        self._require(table, "The")
        version = self._stored(table)
        if version is None:
            raise DataError(f"Table {table} isn't one of this layout's", source="tables", table=table)
        columns = spelled(columns, version.schema.names)
        unknown = [c for c in columns if c not in version.schema.names]
        if unknown or not columns:
            raise DataError(f"Table {table} has no columns {unknown} to index", source="tables", table=table)
        with self._reporting(table, "index"):
            done = [set(r["layers"]) for r in version.ranges if set(columns) <= set(r["columns"])]
            layers = [x for x in version.layers if not any(x in d for d in done)]
            if not layers:
                return 0
            found = self._of_layers(table, version, layers, hidden={"__file": _file(version)}).groupBy("__file").agg(
                F.count(F.lit(1)).alias("__rows"),
                *[f(named(c)).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("low", F.min), ("high", F.max))],
            )
            folder, _ = self._folder(_RANGES)
            seen = self._write(found, (), f"{self.layout.table_path(table)}/{folder}")
            note = {"folder": folder, "columns": columns, "layers": layers}
            while True:
                now = self._stored(table)
                if now is None or now.layers[:1] != version.layers[:1]:
                    raise DataError(f"Table {table} was changed by another writer", source="tables", table=table)
                try:
                    self._commit(table, now, replace(now, ranges=(*now.ranges, note)))
                    return seen.get["rows"]
                except LakeError as e:
                    if isinstance(e, DataError) or self._stored(table) == now:
                        raise

    def _holding(self, table: str, version: _Version, wanted: dict[str, tuple]) -> Column | None:
        """A condition on files that may hold wanted rows; None where nothing is known.

        It names files that fit or files that don't, whichever are fewer. The names of files that fit come to
        the driver as Spark's own file index has them.
        """
        known, covered = None, set()
        for note in version.ranges:
            ends = {i: wanted[c] for i, c in enumerate(note["columns"]) if c in wanted}
            if not ends or not set(note["layers"]) & set(version.layers):
                continue
            rows = self.spark.read.format(self.layout.table_format).load(f"{self.layout.table_path(table)}/{note['folder']}")
            fits = all_of([_within(F.col(f"low{i}"), F.col(f"high{i}"), *e) for i, e in ends.items()])
            rows = rows.select(F.col("__file").alias("file"), F.coalesce(fits, F.lit(False)).alias("fits"))
            known = rows if known is None else known.unionByName(rows)
            covered |= set(note["layers"])
        if known is None:
            return None
        live = known.filter(F.substring_index("file", "/", 1).isin(*version.layers))
        if version.dropped:
            live = live.filter(~F.col("file").isin(*version.dropped))
        live = live.groupBy("file").agg(F.min("fits").alias("fits"))
        many = {r["fits"]: r["count"] for r in live.groupBy("fits").count().collect()}
        if not many.get(False):
            return None
        whole = covered >= set(version.layers)
        kept = whole and many.get(True, 0) <= many[False]
        names = [r["file"] for r in live.filter(F.col("fits") == kept).select("file").collect()]
        if not names:
            return F.lit(False)
        return F.expr(f"{_file(version)} {'' if kept else 'NOT '}IN ({', '.join(map(sql_text, names))})")

    def _files(self, table: str, version: _Version | None, parts: Sequence[str]) -> DataFrame:
        """A row per file that holds rows: partition values, ``__file``, ``__bytes`` and ``__rows``.

        Only partition values and file names are read; rows are counted from file footers.
        """
        file = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__bytes")]
        rows = self._rows(table, version)
        return rows.groupBy(*[named(c) for c in parts], *file).agg(F.count(F.lit(1)).alias("__rows"))

    def partitions(self, table: str) -> DataFrame:
        """A3: one row per partition with ``row_count`` and ``file_count``, combined per file before the shuffle."""
        with self._reporting(table, "get the partitions of"):
            version = self._stored(table)
            parts = self._parts(table, version)
            return self._files(table, version, parts).groupBy(*[named(c) for c in parts]).agg(
                F.sum("__rows").alias("row_count"), F.count(F.lit(1)).alias("file_count")
            )

    def stats(self, table: str) -> DataFrame:
        """A2: one row of table statistics.

        Partition values themselves come from `partitions`, as rows: a table may have too many
        of them for one cell.
        """
        with self._reporting(table, "get statistics of"):
            version = self._stored(table)
            parts, columns = self._parts(table, version), self._schema(table, version).names
            files = self._files(table, version, parts)
        per_part = files.groupBy(*[named(c) for c in parts]).agg(
            F.sum("__rows").alias("r"), F.sum("__bytes").alias("b"), F.count(F.lit(1)).alias("f")
        )
        totals = per_part.agg(
            F.coalesce(F.sum("r"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("b"), F.lit(0)).alias("size_bytes"),
            F.coalesce(F.sum("f"), F.lit(0)).alias("file_count"),
            (F.count(F.lit(1)) if parts else F.lit(0).cast("long")).alias("partition_count"),
        )
        return totals.select(
            F.lit(table).alias("table_name"),
            F.lit(self.layout.table_path(table)).alias("table_path"),
            "row_count",
            F.lit(len(columns)).alias("column_count"),
            F.array(*[F.lit(c) for c in columns]).alias("columns"),
            "partition_count",
            "size_bytes",
            (F.col("size_bytes") / 1048576).alias("size_mb"),
            "file_count",
        )

    # -- writing -----------------------------------------------------------------------

    def _partitioning(self, partition_cols: str | Iterable[str] | None) -> list[str]:
        return parse_partition_cols(self.layout.partition_cols if partition_cols is None else partition_cols)

    def create(
        self,
        table: str,
        schema: StructType | str | None = None,
        partition_cols: str | Iterable[str] | None = None,
    ) -> str:
        """An empty table with ``schema``; without one, only the table's folder."""
        if schema is None:
            self.folders.make(self.layout.table_path(table))
        else:
            empty = self.spark.createDataFrame([], schema)
            self._replace(table, self._stored(table), empty, self._partitioning(partition_cols), False)
        return self.layout.table_path(table)

    def write(
        self,
        table: str,
        df: DataFrame,
        partition_cols: str | Iterable[str] | None = None,
        mode: str = "append",
        schema: StructType | str | None = None,
        cluster: bool = True,
        run_id: str | None = None,
    ) -> Observation | Written:
        """T4, K8: append or overwrite; the returned observation holds the row count.

        A missing table is created, with ``schema`` if given. ``cluster=False`` skips the
        rebalance shuffle for rows already grouped by partition. A write with a ``run_id`` that
        the table has already seen, of the last `RUNS` such, does nothing: a job that is tried
        again can't write its rows twice.
        """
        if mode not in ("append", "overwrite"):
            raise ValueError(f"Unsupported write mode: {mode}")
        version = self._stored(table)
        if version is not None and run_id in version.runs:
            return Written(version.runs[run_id])
        if version is None and mode == "append" and self._is_foreign(table):
            with self._reporting(table, "write to"):
                return self._insert(table, df, cluster)
        if version is None and schema is not None:
            self.create(table, schema, partition_cols)
            version = self._stored(table)
        with self._reporting(table, "write to"):
            if version is not None and mode == "append":
                return self._append(table, version, df, cluster, run_id)
            if partition_cols is None and self.exists(table):
                parts = self._parts(table, version)
            else:
                parts = self._partitioning(partition_cols)
            return self._replace(table, version, df, parts, cluster, run_id)

    def written(self, table: str, run_id: str) -> int | None:
        """The rows that a write of this run has put into the table; None if there was none."""
        version = self._stored(table)
        return version.runs.get(run_id) if version else None

    def append(self, table: str, df: DataFrame, partition_cols=None, **kwargs) -> Observation | Written:
        """K10."""
        return self.write(table, df, partition_cols, "append", **kwargs)

    def overwrite(self, table: str, df: DataFrame, partition_cols=None, **kwargs) -> Observation | Written:
        """K11; ``df`` may read the table being replaced."""
        return self.write(table, df, partition_cols, "overwrite", **kwargs)

    @staticmethod
    def _widened(schema: StructType, parts: Sequence[str], df: DataFrame) -> StructType:
        """``schema`` with the columns that only ``df`` has, partition columns last."""
        fresh = [StructField(f.name, f.dataType) for f in df.schema if f.name not in schema.names]
        return StructType([f for f in schema if f.name not in parts] + fresh + [schema[p] for p in parts])

    def _insert(self, table: str, df: DataFrame, cluster: bool) -> Observation:
        """Append to a table that only the catalog knows; its rows are Spark's to place."""
        have = self.spark.table(self._id(table)).schema
        parts = self._parts(table, None)
        df = spelled_as(df, have.names)
        wide = self._widened(have, parts, df)
        added = StructType([f for f in wide if f.name not in have.names])
        if added:
            self.spark.sql(f"ALTER TABLE {self._id(table)} ADD COLUMNS ({added.toDDL()})")
        aligned = df.select(*[_column_or_null(df, f) for f in wide])  # insertInto goes by position
        aligned, seen = observed_rows(cluster_for(aligned, parts) if cluster else aligned)
        aligned.write.insertInto(self._id(table))
        return seen

    def _append(self, table: str, version: _Version, df: DataFrame, cluster: bool, run_id: str | None) -> Observation | Written:
        df = spelled_as(df, version.schema.names)
        parts, wide = version.partition_columns, self._widened(version.schema, version.partition_columns, df)
        aligned = df.select(*[_stored_as(df, f) for f in wide])
        if cluster:
            aligned = cluster_for(aligned, list(parts))
        layer, _ = self._folder(_APPEND)
        seen = self._write(aligned, parts, f"{self.layout.table_path(table)}/{layer}")
        while True:
            # Whatever came between, the rows of a layer of their own can go on top.
            now = self._stored(table)
            if now is not None and run_id in now.runs:
                self.folders.remove(f"{self.layout.table_path(table)}/{layer}")
                return Written(now.runs[run_id])
            have = {f.name: f.dataType for f in now.schema} if now else {}
            if now is None or now.partition_columns != parts or any(have.get(f.name, f.dataType) != f.dataType for f in wide):
                raise DataError(f"Table {table} was given another form by another writer", source="tables", table=table)
            schema = self._widened(now.schema, parts, aligned)
            following = replace(now, layers=(*now.layers, layer), schema=schema, runs=_with_run(now, run_id, seen))
            try:
                self._commit(table, now, following)
                return seen
            except LakeError as e:
                if isinstance(e, DataError) or self._stored(table) == now:
                    raise

    def _folder(self, kind: str) -> tuple[str, str]:
        """Names of a new folder and of an entry that goes with it."""
        token = uuid.uuid4().hex[:8]
        return f"{kind}-{datetime.now(timezone.utc).strftime(_STAMP)}-{token}", token

    def _write(self, df: DataFrame, parts: Sequence[str], path: str) -> Observation:
        df, seen = observed_rows(df)
        writer = df.write.format(self.layout.table_format).option("compression", self.layout.compression)
        if parts:
            writer = writer.partitionBy(*parts)
        try:
            writer.save(path)
        except Exception:
            self.folders.remove(path)
            raise
        return seen

    def _replace(
        self,
        table: str,
        base: _Version | None,
        df: DataFrame,
        partition_cols: Sequence[str],
        cluster: bool,
        run_id: str | None = None,
    ) -> Observation:
        """A new snapshot in place of all layers of ``base``."""
        parts = spelled(partition_cols, df.columns)
        df = df.select(*[named(c) for c in df.columns if c not in parts], *[named(c) for c in parts])
        schema = StructType([StructField(f.name, f.dataType) for f in df.schema])
        if cluster:
            df = cluster_for(df, parts)
        snapshot, token = self._folder(_SNAPSHOT)
        seen = self._write(df, parts, f"{self.layout.table_path(table)}/{snapshot}")
        runs = _with_run(base, run_id, seen)
        self._commit_alone(table, base, _Version(0, token, (snapshot,), schema, tuple(parts), runs))
        return seen

    def compact(self, table: str, whole: bool = False, order_by: Sequence[str] = ()) -> list[str]:
        """Fold layers into fewer, larger files; returns the folders that the table no longer uses.

        Appends that no delta follows become one layer, at the cost of their rows alone. ``whole`` folds all layers
        into a new snapshot. Adaptive execution sizes the files. With ``order_by`` rows are laid out by ranges of these
        columns, in order within a file; a value that many rows have is spread over files. Readers keep the old layers until `vacuum`; appends
        that come meanwhile stay, and any other change refuses the fold.
        """
        self._require(table, "The")
        version = self._stored(table)
        if version is None:
            raise DataError(f"Table {table} isn't one of this layout's", source="tables", table=table)
        first = len(version.layers)
        while first and version.layers[first - 1].startswith(_APPEND):
            first -= 1
        first = 0 if whole else first
        folded = version.layers[first:]
        if len(folded) < 2 and not (whole and (version.dropped or order_by)):
            return []
        with self._reporting(table, "compact"):
            rows = self._of_layers(table, version, folded)
            layer, token = self._folder(_APPEND if first else _SNAPSHOT)
            parts = list(version.partition_columns)
            order = [named(c) for c in spelled(order_by, rows.columns)]
            if order:
                rows = self._by_ranges(rows, [*map(named, parts), *order])
            grouped = rows if order else cluster_for(rows, parts) if parts else rows.hint("rebalance")
            self._write(grouped, parts, f"{self.layout.table_path(table)}/{layer}")
            while True:
                now = self._stored(table)
                if now is None or now.layers[: len(version.layers)] != version.layers:
                    raise DataError(f"Table {table} was changed by another writer", source="tables", table=table)
                layers = (*version.layers[:first], layer, *now.layers[len(version.layers) :])
                try:
                    dropped = now.dropped if first else tuple(x for x in now.dropped if x not in version.dropped)
                    ranges = tuple(r for r in now.ranges if set(r["layers"]) & set(layers))
                    self._commit(table, now, replace(now, entry=token, layers=layers, dropped=dropped, ranges=ranges))
                    return list(folded)
                except LakeError as e:
                    if isinstance(e, DataError) or self._stored(table) == now:
                        raise

    @staticmethod
    def _by_ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
        """Rows in ranges of ``order``, ties apart by a digest of the row, so that no range is one hot value's alone."""
        plain = [named(f.name) for f in rows.schema if "map<" not in f.dataType.simpleString()]
        return rows.repartitionByRange(*order, F.xxhash64(*plain)).sortWithinPartitions(*order)

    def vacuum(self, table: str, older_than: timedelta = timedelta(days=7)) -> list[str]:
        """Remove what the current version doesn't use and is older than that; returns the folders' names.

        These are replaced layers and what unfinished writes have left. Data that lies elsewhere
        is not this library's to remove. Readers and writers that are older than ``older_than`` must be done.
        """
        stored, home = self._stored(table), self.layout.table_path(table)
        limit = (datetime.now(timezone.utc) - older_than).strftime(_STAMP)
        used = {*stored.layers, *(r["folder"] for r in stored.ranges)} if stored else set()
        gone = [
            f for f in self.folders.children(home)
            if f.split("-")[0] in (_SNAPSHOT, _APPEND, _DELTA, _RANGES) and f not in used and f.split("-")[1] < limit
        ]
        for folder in gone:
            self.folders.remove(f"{home}/{folder}")
        last = _file_name(stored.number) if stored else ""
        for file in self.folders.files(self.layout.metadata_path(table)):
            if gone and (file < last or file.endswith(".tmp")):
                self.folders.remove(f"{self.layout.metadata_path(table)}/{file}")
        if gone and stored:
            # Entries of earlier states show layers that are gone.
            for t in self._listed():
                if t.name.startswith(f"{table}{_ENTRY}".lower()) and not t.name.endswith(f"{_ENTRY}{stored.entry}"):
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._id(t.name)}")
        return gone

    def drop(self, table: str) -> None:
        """The catalog entries and every snapshot. Dropping a missing table does nothing."""
        for t in self._listed():
            if t.name == table.lower() or t.name.startswith(f"{table}{_ENTRY}".lower()):
                self.spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} {self._id(t.name)}")
        self._known.pop(table, None)
        self._read.pop(table, None)
        self.folders.remove(self.layout.table_path(table))

    def copy(self, source: str, dest: str, overwrite: bool = False) -> str:
        """``dest`` gets the rows and partitioning of ``source``.

        Files are read partition by partition, so no shuffle is needed to write them that way.
        """
        self._require(source, "Source")
        if self.exists(dest) and not overwrite:
            raise DataError(f"Destination table {dest} already exists", source="tables", table=dest)
        self.write(dest, self.read(source), self.partition_columns(source), "overwrite", cluster=False)
        return self.layout.table_path(dest)

    def merge(
        self,
        source: str,
        dest: str,
        keys: Sequence[str],
        update_columns: Sequence[str] | None = None,
        order_by: Sequence[str] = (),
        touched_only: bool = False,
        by_file: bool = False,
    ) -> MergeResult:
        """Upsert the rows of ``source`` into ``dest``, keeping its partitioning.

        By default a new snapshot replaces the table, so that the cost follows the destination's size.
        ``touched_only`` rewrites just the partitions that matching or new rows fall into, into a delta of
        their own; the others are neither read nor written. It applies to partitioned tables whose
        partition columns the merge does not update.

        ``by_file`` works for every table: it finds the files that hold a matching key, by a scan of the keys
        alone, rewrites just these together with the new rows into a layer of their own, and names them in the
        version as dropped. Its cost beyond that scan follows the files touched. `compact` folds such layers.

        The counts need no extra join: updates never change the number of rows, so what the table gained
        is what was inserted.
        """
        self._require(source, "Source")
        self._require(dest, "Destination")
        version = self._stored(dest)
        with self._reporting(dest, "merge into"):
            incoming, current = self.read(source), self._rows(dest, version)
            offered = incoming.count()
            parts = self._parts(dest, version)
            if by_file and version is not None:
                inserted = self._merge_files(dest, version, incoming, current, keys, update_columns, order_by)
                return MergeResult(self.layout.table_path(dest), offered, offered - inserted, inserted)
            moves = set(parts) & set(update_set(incoming, current, keys, update_columns, order_by))
            whole = not touched_only or not parts or bool(moves)
            if not whole:
                current = current.filter(self._in_touched(incoming, current, keys, parts))
            merged = merge(incoming, current, keys, update_columns, order_by, parts)
            before = current.count()
            if whole:
                after = self._replace(dest, version, merged, parts, cluster=False).get["rows"]
            else:
                after = self._replace_partitions(dest, version, merged).get["rows"]
        inserted = after - before
        return MergeResult(self.layout.table_path(dest), offered, offered - inserted, inserted)

    def _merge_files(
        self,
        table: str,
        base: _Version,
        source: DataFrame,
        dest: DataFrame,
        keys: Sequence[str],
        update_columns: Sequence[str] | None,
        order_by: Sequence[str],
    ) -> int:
        """Merge into the files that hold matching keys; returns the number of new rows."""
        parts, column = list(base.partition_columns), f"file_{uuid.uuid4().hex}"
        file = F.expr(_file(base))
        placed = dest.select(*[named(k) for k in spelled(keys, dest.columns)], file.alias(column))
        # Names of files, no more than the version will list.
        touched = [r[0] for r in matching_rows(source, placed, keys).select(column).distinct().collect()]
        rows = dest.filter(file.isin(*touched)) if touched else dest.limit(0)
        before = rows.count()
        merged = merge(source, rows, keys, update_columns, order_by, parts)
        schema = self._widened(base.schema, parts, merged)
        layer, _ = self._folder(_APPEND)
        rewritten = merged.select(*[_column_or_null(merged, f) for f in schema])
        seen = self._write(rewritten, parts, f"{self.layout.table_path(table)}/{layer}")
        after = seen.get["rows"]
        if after:
            dropped = (*base.dropped, *touched)
            self._commit_alone(table, base, replace(base, layers=(*base.layers, layer), schema=schema, dropped=dropped))
        return after - before

    def _in_touched(self, source: DataFrame, dest: DataFrame, keys: Sequence[str], parts: list[str]) -> Column:
        """A predicate for every partition of ``dest`` that a merge may change.

        It names partitions that the destination has, which the catalog lists too, so it is no longer than
        that list, however large the source is.
        """
        source = spelled_as(source, dest.columns)
        fields = [dest.schema[p] for p in parts]
        have = dest.select(*[named(p) for p in parts]).distinct()
        touched = source.select(*[_column_or_null(source, f).cast(f.dataType).alias(f.name) for f in fields])
        if not set(parts) <= set(spelled(keys, dest.columns)):
            matching = matching_rows(source, dest, keys).select(*[named(p) for p in parts])
            touched = touched.unionByName(matching)
        touched = touched.distinct().toDF(*[f"__{i}" for i in range(len(parts))])
        same = all_of([named(p).eqNullSafe(F.col(f"__{i}")) for i, p in enumerate(parts)])
        # As text, so that dates and times come back exactly, whatever the driver's time zone.
        texts = have.join(touched, same, "left_semi").select(*[named(p).cast("string") for p in parts])
        specs = [
            F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in texts.collect()
        ]
        return F.struct(*[named(p) for p in parts]).isin(specs) if specs else F.lit(False)

    def _replace_partitions(self, table: str, base: _Version | None, df: DataFrame) -> Observation:
        """Put the partitions that ``df`` has rows of in place of those the table has."""
        if base is None:
            raise DataError(f"Table {table} isn't one of this layout's", source="tables", table=table)
        parts = base.partition_columns
        schema = self._widened(base.schema, parts, df)
        delta, token = self._folder(_DELTA)
        rows = df.select(*[_column_or_null(df, f) for f in schema])
        seen = self._write(rows, parts, f"{self.layout.table_path(table)}/{delta}")
        if seen.get["rows"]:
            self._commit_alone(table, base, replace(base, entry=token, layers=(*base.layers, delta), schema=schema))
        return seen

    def attach(self, table: str, schema: StructType | None = None, partition_cols: Sequence[str] = ()) -> None:
        """Register a table of the layout, as every other call does by itself.

        A folder of files without metadata becomes a table by this call: its newest complete snapshot, with
        ``schema`` and ``partition_cols`` where folder names alone cannot tell types.
        """
        version = self._stored(table)
        if version is not None:
            self._attach(table, version)
        if version is not None or self._is_foreign(table):
            return
        home = self.layout.table_path(table)
        done = [s for s in self.folders.children(home) if self.folders.exists(f"{home}/{s}/_SUCCESS")]
        snapshots = [s for s in done if s.startswith("snapshot-")]
        if not snapshots:
            raise DataError(f"No complete snapshot of table {table}", source="tables", table=table)
        with self._reporting(table, "attach"):
            found = self.spark.read.format(self.layout.table_format).load(f"{home}/{snapshots[-1]}").schema
        if not partition_cols:
            depth, at = [], f"{home}/{snapshots[-1]}"
            while inner := [c for c in self.folders.children(at) if "=" in c]:
                depth.append(unquote(inner[0].split("=", 1)[0]))
                at = f"{at}/{inner[0]}"
            partition_cols = spelled(depth, found.names)
        schema = schema or found
        parts = [f for f in schema if f.name in partition_cols]
        schema = StructType([f for f in schema if f.name not in partition_cols] + parts)
        self._commit_alone(table, None, _Version(0, uuid.uuid4().hex[:8], (snapshots[-1],), schema, tuple(partition_cols)))

    def attach_all(self) -> list[str]:
        """`attach` every table folder of the layout that the catalog does not show; returns their names."""
        home = self.layout.database_path.rstrip("/")
        shown = {t.name for t in self._listed()}
        found = [
            t
            for t in self.folders.children(home)
            if t.lower() not in shown and any(s.startswith("snapshot-") for s in self.folders.children(f"{home}/{t}"))
        ]
        for table in found:
            self.attach(table)
        return found


_STAMP = "%Y%m%dT%H%M%S%f"


def _within(low: Column, high: Column, least, greatest) -> Column:
    """Whether values from ``low`` to ``high`` may lie between two values, None for an open end."""
    ends = [high >= F.lit(least)] if least is not None else []
    ends += [low <= F.lit(greatest)] if greatest is not None else []
    return all_of(ends) if ends else low.isNotNull()


def _with_run(base: _Version | None, run_id: str | None, seen: Observation) -> dict[str, int]:
    """The runs of ``base``, the oldest forgotten if there are too many, and this one."""
    runs = dict(base.runs) if base else {}
    if run_id is not None:
        runs[run_id] = seen.get["rows"]
    return dict(list(runs.items())[-RUNS:])


def _file_name(number: int) -> str:
    return f"v{number:012d}.json"


def _spec(folder: str) -> str:
    """The partition that a folder like ``a=1/b=x%20y`` holds, as SQL names it."""
    pairs = [part.split("=", 1) for part in folder.split("/")]
    return ", ".join(
        f"{quoted(unquote(name))} = {'NULL' if value == _NULL_PARTITION else sql_text(unquote(value))}"
        for name, value in pairs
    )
