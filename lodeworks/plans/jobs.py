"""The ingest and processing jobs.

Each job pins one clock value, checks its formats before reading, and leaves one audit row
whether it succeeds or fails. Row counts are observed by the writing stage, so no job reads
its source just to count it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodeworks.errors import PipelineError
from lodeworks.functions.columns import pinned_now
from lodeworks.functions.lineage import Transform, apply_transforms, stamp_bronze, stamp_silver
from lodeworks.layout import LakeLayout, parse_partition_cols
from lodeworks.operators import quality
from lodeworks.operators.audit import AuditLog, RunAudit
from lodeworks.operators.tables import TableStore
from lodeworks.sinks.writers import SINKS, SMALL_SINKS, write_dataset
from lodeworks.sources.readers import (
    BRONZE_SOURCES,
    SILVER_SOURCES,
    SMALL_SOURCES,
    read_source,
    require_format,
)
from lodeworks.storage import Folders, work_folder


@dataclass(frozen=True)
class BronzeJob:
    """E1. ``source_label`` is what ``bronze_source_path`` records; the path unless given.

    ``cluster=False`` skips the shuffle by partition, for sources already grouped that way.
    """

    source_type: str
    source_path: str | None
    target_path: str
    file_format: str = "parquet"
    partition_cols: str | Sequence[str] = ()
    source_options: Mapping[str, str] = field(default_factory=dict)
    sink_options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None
    transforms: Sequence[Transform] = ()
    source_label: str | None = None
    stamp_source: bool = True
    cluster: bool = True
    run_ts: datetime | str | None = None
    job_name: str = "bronze_ingest"
    sources: tuple[str, ...] = BRONZE_SOURCES
    sinks: tuple[str, ...] = SINKS


@dataclass(frozen=True)
class SilverJob:
    """E2. ``quality_checks`` is the bypass switch (Q4); only true, or the text "true", checks.

    ``stage=True`` writes the stamped rows to the shared work folder once and splits from
    there. Use it when ``transforms`` are not repeatable, or far dearer than writing the rows.
    ``cluster=False`` skips the shuffle by partition, for a bronze layer with the same partitions.
    ``run_id`` names the piece of work, whoever tries it: a run that finds its id done does nothing, one
    that finds half of it does the other half over.
    """

    source_path: str
    source_format: str
    table: str
    partition_cols: str | Sequence[str] | None = None
    quality_checks: bool | str = True
    rules: Sequence[quality.Rule] = ()
    source_options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None
    transforms: Sequence[Transform] = ()
    source_label: str | None = None
    mode: str = "append"
    stage: bool = False
    cluster: bool = True
    run_ts: datetime | str | None = None
    run_id: str | None = None
    job_name: str = "silver_process"


class _Run:
    """The audit row of a job in progress."""

    def __init__(self, audit: RunAudit):
        self.audit = audit


@contextmanager
def _audited(
    spark: SparkSession, log: AuditLog | None, job_name: str, params: Mapping[str, object]
) -> Iterator[_Run]:
    capacity = spark.sparkContext.defaultParallelism
    run = _Run(RunAudit(job_name, capacity=capacity, params={k: str(v) for k, v in params.items()}))
    try:
        yield run
    except Exception as e:
        run.audit = run.audit.failed(e)
        if log is not None:
            log.append(run.audit)
        raise
    if log is not None:
        log.append(run.audit)


def _rows_read(source: DataFrame, transforms: Sequence[Transform], written: int) -> int:
    """How many rows the source had.

    Without transforms that is what was written. Transforms may add or drop rows, so then the
    source is counted: from file footers for Parquet and ORC, by one more scan for text.
    """
    return source.count() if transforms else written


def ingest_bronze(spark: SparkSession, job: BronzeJob, log: AuditLog | None = None) -> RunAudit:
    """Read, stamp, transform, append."""
    params = {
        "source_type": job.source_type,
        "source_path": job.source_path,
        "target_path": job.target_path,
        "file_format": job.file_format,
        "partition_cols": ",".join(parse_partition_cols(job.partition_cols)),
    }
    with _audited(spark, log, job.job_name, params) as run:
        require_format(job.source_type, job.sources, "source format")
        require_format(job.file_format, job.sinks, "file format")
        source = read_source(spark, job.source_type, job.source_path, job.source_options, job.schema, job.sources)
        label = (job.source_label or job.source_path or "") if job.stamp_source else None
        df = apply_transforms(stamp_bronze(source, label, job.run_ts or pinned_now()), job.transforms)
        seen = write_dataset(
            df,
            job.target_path,
            job.file_format,
            job.partition_cols,
            job.sink_options,
            cluster=job.cluster,
            allowed=job.sinks,
        )
        rows = seen.get["rows"]
        run.audit = run.audit.succeeded(
            rows_read=_rows_read(source, job.transforms, rows), column_count=len(source.columns), rows_written=rows
        )
    return run.audit


def small_ingest(spark: SparkSession, job: BronzeJob, log: AuditLog | None = None) -> RunAudit:
    """The small-data flavour: csv/json/parquet only and no source path column."""
    narrowed = replace(job, stamp_source=False, sources=SMALL_SOURCES, sinks=SMALL_SINKS)
    return ingest_bronze(spark, narrowed, log)


def _checks_wanted(switch: bool | str) -> bool:
    return switch if isinstance(switch, bool) else switch.strip().lower() == "true"


def process_silver(
    spark: SparkSession, layout: LakeLayout, job: SilverJob, log: AuditLog | None = None
) -> RunAudit:
    """Read, stamp, split by quality, write the table and the quarantine (K8, K9).

    The quarantine goes first, so that whatever fails, no row is in neither place. Over Parquet or
    ORC its pass skips row groups whose statistics show no NULL, and a look for one invalid row ends
    at the first; an input without any leaves no quarantine files.
    """
    params = {
        "source_path": job.source_path,
        "source_format": job.source_format,
        "table_name": job.table,
        "partition_cols": ",".join(parse_partition_cols(job.partition_cols)),
        "apply_quality_checks": job.quality_checks,
    }
    with _audited(spark, log, job.job_name, params) as run:
        store = TableStore(spark, layout)
        source = read_source(
            spark, job.source_format, job.source_path, job.source_options, job.schema, SILVER_SOURCES
        )
        width = len(source.columns)
        df = stamp_silver(source, job.source_label or job.source_path, job.run_ts or pinned_now())
        df = apply_transforms(df, job.transforms)
        checked = _checks_wanted(job.quality_checks)
        done = store.written(job.table, job.run_id) if job.run_id is not None else None
        if done is not None:
            n_invalid = quarantined(spark, layout, job.table, job.run_id) if checked else 0
        elif not checked:
            done, n_invalid = _write_silver(store, job, df), 0
        else:
            with _staged(spark, df) if job.stage else nullcontext(df) as rows:
                invalid, n_invalid = quality.invalid_rows(rows, job.rules), 0
                if job.run_id is not None:
                    _clear_quarantine(spark, layout, job.table, job.run_id)
                if not invalid.select(F.lit(1)).isEmpty():
                    n_invalid = write_quarantine(invalid, layout, job.table, job.run_id)
                done = _write_silver(store, job, quality.valid_rows(rows, job.rules))
        run.audit = run.audit.succeeded(
            rows_read=_rows_read(source, job.transforms, done + n_invalid),
            column_count=width,
            rows_written=done,
            **({"rows_valid": done, "rows_invalid": n_invalid} if checked else {}),
        )
    return run.audit


def _write_silver(store: TableStore, job: SilverJob, rows: DataFrame) -> int:
    seen = store.write(job.table, rows, job.partition_cols, job.mode, cluster=job.cluster, run_id=job.run_id)
    return seen.get["rows"]


def _run_mark(run_id: str) -> str:
    """What the names of a run's quarantine files begin with, whatever the id is made of."""
    return f"run-{hashlib.sha256(run_id.encode()).hexdigest()[:32]}-"


def _run_files(spark: SparkSession, layout: LakeLayout, table: str, run_id: str) -> list[str]:
    home, mark = layout.quarantine_path(table), _run_mark(run_id)
    return [f"{home}/{name}" for name in Folders(spark).files(home) if name.startswith(mark)]


def _clear_quarantine(spark: SparkSession, layout: LakeLayout, table: str, run_id: str) -> None:
    """Take back what an unfinished try of this run has left."""
    folders = Folders(spark)
    for path in _run_files(spark, layout, table, run_id):
        folders.remove(path)
    stage = f"{layout.quarantine_path(table)}/_{_run_mark(run_id)}"
    if folders.exists(stage):
        folders.remove(stage)


def quarantined(spark: SparkSession, layout: LakeLayout, table: str, run_id: str) -> int:
    """How many rows a run has put into the quarantine, from file footers."""
    files = _run_files(spark, layout, table, run_id)
    return spark.read.parquet(*files).count() if files else 0


def write_quarantine(invalid: DataFrame, layout: LakeLayout, table: str, run_id: str | None = None) -> int:
    """K9: append rows to the table's quarantine; returns how many.

    Rows of a named run are written aside, in a folder that readers pass over, and their files then moved in.
    """
    home = layout.quarantine_path(table)
    if run_id is None:
        return write_dataset(invalid, home, "parquet").get["rows"]
    folders, mark = Folders(invalid.sparkSession), _run_mark(run_id)
    stage = f"{home}/_{mark}"
    rows = write_dataset(invalid, stage, "parquet").get["rows"]
    for name in folders.files(stage):
        if not name.startswith("_"):
            folders.move(f"{stage}/{name}", f"{home}/{mark}{name}")
    folders.remove(stage)
    return rows


@contextmanager
def _staged(spark: SparkSession, df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared work folder, for as long as it is needed."""
    path = work_folder(spark, "stage")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        Folders(spark).remove(path)


def bronze_to_silver(
    spark: SparkSession,
    layout: LakeLayout,
    bronze: BronzeJob,
    silver: SilverJob,
    log: AuditLog | None = None,
) -> tuple[RunAudit, RunAudit]:
    """Ingest, then process what was ingested. The silver job must read the bronze target."""
    if (silver.source_path, silver.source_format) != (bronze.target_path, bronze.file_format):
        raise PipelineError(
            "the silver job does not read the bronze job's output", pipeline_name="bronze_to_silver", stage="plan"
        )
    return ingest_bronze(spark, bronze, log), process_silver(spark, layout, silver, log)
