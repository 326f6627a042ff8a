"""Incremental ingest into files or into a table, with a resettable bookmark (B1, B2).

The bookmark is a Structured Streaming checkpoint: a run takes the files that no committed
run has taken, and a failed run does not advance. Output lives in generations::

    <root>/g0/data   <root>/g0/checkpoint
    <root>/g1/...                           after one reset

A reset starts a new generation, because the file sink remembers in its output folder which
batches it has written: a fresh checkpoint over old output would be skipped silently.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lodeworks.errors import DataError
from lodeworks.functions.columns import spelled
from lodeworks.functions.lineage import Transform, apply_transforms, stamp_bronze, stamp_silver
from lodeworks.layout import parse_partition_cols
from lodeworks.operators import quality
from lodeworks.operators.tables import TableStore
from lodeworks.sinks.writers import SINK_DEFAULTS, SINKS, cluster_for, csv_options, marked
from lodeworks.sources.readers import CSV_DEFAULTS, SILVER_SOURCES, read_source, require_format, unmarked
from lodeworks.storage import Folders


# A file counts however old it is beside the newest: copies and late deliveries keep their times. The list of
# files seen, which the driver holds, then only shrinks when files go: see ``cleanSource`` at `IncrementalIngest`.
_SOURCE_DEFAULTS = {"maxFileAge": "36500d"}

Stamp = Callable[[DataFrame, str, datetime | str | None], DataFrame]


class IncrementalIngest:
    """Ingest of a growing folder into files, each source file once per generation.

    ``stamp`` adds the layer's lineage columns and ``transforms`` follow it. Rows of a batch are
    clustered by the partition columns before they are written. ``options`` go to the file source;
    ``cleanSource`` with ``archive`` or ``delete`` keeps the source folder, and the list of files
    seen, short over the years.
    """

    def __init__(
        self,
        spark: SparkSession,
        source_path: str,
        fmt: str,
        schema: StructType | str,
        root: str,
        options: Mapping[str, str] | None = None,
        sink_format: str = "parquet",
        partition_cols: str | Iterable[str] | None = None,
        transforms: Iterable[Transform] = (),
        source_label: str | None = None,
        stamp: Stamp = stamp_bronze,
    ):
        self.spark = spark
        self.source_path = source_path
        self.fmt = require_format(fmt, SILVER_SOURCES, "source format")
        self.sink_format = require_format(sink_format, SINKS, "file format")
        self.schema = schema
        self.root = root.rstrip("/")
        self.options = dict(options or {})
        self.partition_cols = parse_partition_cols(partition_cols)
        self.transforms = tuple(transforms)
        self.source_label = source_label or source_path
        self.stamp = stamp
        self.folders = Folders(spark)

    def generations(self) -> list[int]:
        names = self.folders.children(self.root)
        return sorted(int(n[1:]) for n in names if n[:1] == "g" and n[1:].isdigit())

    def _home(self, generation: int) -> str:
        return f"{self.root}/g{generation}"

    def _steps(self, incoming: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
        return apply_transforms(self.stamp(incoming, self.source_label, run_ts), self.transforms)

    def _incoming(self) -> DataFrame:
        """The source folder as a stream."""
        reader = self.spark.readStream.format(self.fmt).schema(self.schema)
        if self.fmt == "csv":
            reader = reader.options(**CSV_DEFAULTS)
        incoming = reader.options(**{**_SOURCE_DEFAULTS, **self.options}).load(self.source_path)
        return unmarked(incoming) if self.fmt == "csv" else incoming

    def run(self, run_ts: datetime | str | None = None) -> None:
        """Take everything that is new, then stop.

        A large backlog is worked off in several batches when ``options`` sets
        ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``; each batch commits on its own.
        """
        home = self._home((self.generations() or [0])[-1])
        rows = self._steps(self._incoming(), run_ts)
        parts = spelled(self.partition_cols, rows.columns)
        options = SINK_DEFAULTS[self.sink_format]
        if self.sink_format == "csv":
            rows, options = marked(rows, parts), {**options, **csv_options(len(rows.columns) - len(parts))}
        writer = (
            cluster_for(rows, parts)
            .writeStream.format(self.sink_format)
            .options(**options)
            .option("path", f"{home}/data")
            .option("checkpointLocation", f"{home}/checkpoint")
            .trigger(availableNow=True)
        )
        if parts:
            writer = writer.partitionBy(*parts)
        writer.start().awaitTermination()

    def reset(self) -> int:
        """B2: the next run takes every file again, into a new generation."""
        current = self.generations()
        following = current[-1] + 1 if current else 0
        self.folders.make(self._home(following))
        return following

    def read(self) -> DataFrame:
        """All rows of all generations. Each folder is read whole, so the sink's log is honoured."""
        homes = [f"{self._home(g)}/data" for g in self.generations()]
        schema = self._steps(self.spark.createDataFrame([], self.schema)).schema
        parts = [read_source(self.spark, self.sink_format, h, schema=schema) for h in homes if self.folders.exists(h)]
        if not parts:
            raise DataError("Nothing has been ingested yet", source="incremental", path=self.root)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


class IncrementalTable(IncrementalIngest):
    """Ingest of a growing folder into a stored table, each source file once per generation (B1 into K8).

    A batch is one append of the table, under an id made of the stream's and the batch's number, which the
    table's version takes with the rows. So a batch that failed after its append, and comes again as its checkpoint
    doesn't know of it, adds nothing. Readers of the table see whole batches only. ``root`` holds checkpoints.
    """

    def __init__(self, spark: SparkSession, store: TableStore, table: str, source_path: str, fmt: str,
                 schema: StructType | str, root: str, **settings):
        super().__init__(spark, source_path, fmt, schema, root, **settings)
        self.store = store
        self.table = table

    def run(self, run_ts: datetime | str | None = None) -> None:
        home = self._home((self.generations() or [0])[-1])
        checkpoint = f"{home}/checkpoint"

        def take(batch: DataFrame, number: int) -> None:
            # Spark keeps the stream's own id beside its bookmark, so a bookmark made anew has another.
            stream = json.loads(self.folders.read_text(f"{checkpoint}/metadata"))["id"]
            rows = self._steps(batch, run_ts)
            self.store.append(self.table, rows, self.partition_cols, run_id=f"{stream}/{number}")

        writer = self._incoming().writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    def read(self) -> DataFrame:
        """The table, with whatever else was written to it."""
        if not self.store.exists(self.table):
            raise DataError("Nothing has been ingested yet", source="incremental", path=self.root)
        return self.store.read(self.table)


def incremental_split(
    spark: SparkSession,
    source_path: str,
    fmt: str,
    schema: StructType | str,
    root: str,
    rules: Sequence[quality.Rule] = (),
    **settings,
) -> tuple[IncrementalIngest, IncrementalIngest]:
    """The silver step over new files only: one ingest of the valid rows, one of the invalid.

    Each keeps its own bookmark, so a failure of one leaves the other exact.
    """

    def ingest(name: str, keep: Transform) -> IncrementalIngest:
        steps = [*settings.get("transforms", ()), keep]
        home = f"{root.rstrip('/')}/{name}"
        return IncrementalIngest(
            spark, source_path, fmt, schema, home, **{**settings, "transforms": steps, "stamp": stamp_silver}
        )

    return (
        ingest("valid", lambda df: quality.valid_rows(df, rules)),
        ingest("invalid", lambda df: quality.invalid_rows(df, rules)),
    )
