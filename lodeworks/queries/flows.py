"""E1-E5, Q3, Q4, K8, K9, B1, B2 over events with blanked cells."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodeworks.operators import quality
from lodeworks.operators.audit import AuditLog, run_metrics
from lodeworks.operators.tables import TableStore
from lodeworks.plans.jobs import BronzeJob, SilverJob, bronze_to_silver, ingest_bronze, process_silver, small_ingest
from lodeworks.queries.base import (
    DIRTY_SQL,
    ISSUES_SQL,
    RUN_TS,
    Registry,
    blank_some,
    fresh_layout,
    naive,
    table,
)
from lodeworks.queries.stamps import BRONZE_SQL, SILVER_SQL
from lodeworks.sinks.writers import write_dataset
from lodeworks.sources.readers import read_source
from lodeworks.streaming.incremental import IncrementalIngest, IncrementalTable, incremental_split

registry = Registry()

_STAMPED = f"""WITH dirty AS ({DIRTY_SQL})
SELECT *, {BRONZE_SQL}, 'landing/events' AS bronze_source_path, {SILVER_SQL}, 'bronze/events' AS silver_source_path
"""


def _bronze_job(sf_dir, layout, **changes):
    settings = dict(
        source_type="parquet",
        source_path=f"{sf_dir}/events.parquet",
        target_path=layout.bronze_path("events"),
        transforms=[blank_some],
        source_label="landing/events",
        run_ts=RUN_TS,
    )
    return BronzeJob(**{**settings, **changes})


def _silver_job(layout, **changes):
    settings = dict(
        source_path=layout.bronze_path("events"),
        source_format="parquet",
        table="events",
        partition_cols="event_type",
        source_label="bronze/events",
        run_ts=RUN_TS,
    )
    return SilverJob(**{**settings, **changes})


def _chain(spark, sf_dir, bronze=None, silver=None):
    layout = fresh_layout(spark)
    log = AuditLog(spark, layout.audit_path)
    bronze_to_silver(
        spark, layout, _bronze_job(sf_dir, layout, **(bronze or {})), _silver_job(layout, **(silver or {})), log
    )
    return layout, log


def _silver_rows(spark, layout):
    rows = TableStore(spark, layout).read("events")
    return naive(rows, "bronze_ingest_timestamp", "silver_process_timestamp")


@registry.query("bronze_to_silver", f"{_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL")
def flagship(spark, sf_dir):
    """Raw events through both layers; the valid rows of the silver table."""
    layout, _ = _chain(spark, sf_dir)
    return _silver_rows(spark, layout)


@registry.query(
    "bronze_to_silver_json", f"{_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL"
)
def bronze_to_silver_json(spark, sf_dir):
    """The same through a JSON bronze layer, staged once before the split."""
    schema = table(spark, sf_dir, "events").schema
    for name in ("bronze_ingest_timestamp", "bronze_ingest_date", "bronze_ingest_time", "bronze_source_path"):
        schema = schema.add(name, "string")
    layout, _ = _chain(
        spark, sf_dir, {"file_format": "json"}, {"source_format": "json", "schema": schema, "stage": True}
    )
    return _silver_rows(spark, layout)


@registry.query(
    "quarantine",
    f"{_STAMPED}, {ISSUES_SQL} AS data_quality_issues FROM dirty WHERE {ISSUES_SQL} IS NOT NULL",
)
def quarantine(spark, sf_dir):
    layout, _ = _chain(spark, sf_dir)
    rows = spark.read.parquet(layout.quarantine_path("events"))
    return naive(rows, "bronze_ingest_timestamp", "silver_process_timestamp")


@registry.query("dq_bypass", f"{_STAMPED} FROM dirty")
def dq_bypass(spark, sf_dir):
    layout, _ = _chain(spark, sf_dir, silver={"quality_checks": "false"})
    return _silver_rows(spark, layout)


@registry.query(
    "silver_custom_rules",
    f"{_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL AND NOT value < 5",
)
def silver_custom_rules(spark, sf_dir):
    layout, _ = _chain(spark, sf_dir, silver={"rules": [quality.Rule("value below 5", "value < 5")]})
    return _silver_rows(spark, layout)


@registry.query(
    "silver_overwrite",
    f"{_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL",
)
def silver_overwrite(spark, sf_dir):
    """The write mode counts: a second run in overwrite mode leaves one copy of the rows."""
    layout, _ = _chain(spark, sf_dir)
    process_silver(spark, layout, _silver_job(layout, mode="overwrite"))
    return _silver_rows(spark, layout)


@registry.query(
    "silver_all_invalid",
    f"""{_STAMPED}, nullif(concat_ws(', ', {ISSUES_SQL}, 'nothing is good enough'), '') AS data_quality_issues FROM dirty""",
)
def silver_all_invalid(spark, sf_dir):
    """A rule that every row breaks: the table is there and empty, the quarantine has everything."""
    layout, _ = _chain(spark, sf_dir, silver={"rules": [quality.Rule("nothing is good enough", "true")]})
    assert _silver_rows(spark, layout).isEmpty()
    rows = spark.read.parquet(layout.quarantine_path("events"))
    return naive(rows, "bronze_ingest_timestamp", "silver_process_timestamp")


@registry.query(
    "silver_two_sessions",
    f"SELECT r.* FROM ({_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL) r CROSS JOIN range(2)",
)
def silver_two_sessions(spark, sf_dir):
    """A second nightly run through a catalog that knows nothing: both runs' rows."""
    layout, _ = _chain(spark, sf_dir)
    later = replace(layout, database=layout.database + "_later")
    process_silver(spark, later, _silver_job(later))
    return _silver_rows(spark, replace(layout, database=layout.database + "_third"))


def _retried(spark, sf_dir):
    """A named silver run that fails after its quarantine, then before its commit, then succeeds, and comes once more."""
    layout = fresh_layout(spark)
    ingest_bronze(spark, _bronze_job(sf_dir, layout))
    job, write, commit = _silver_job(layout, run_id="2024-06-01"), TableStore.write, TableStore._commit

    def lost(*args, **kwargs):
        raise ConnectionError("lost")

    for method in ("write", "_commit"):
        setattr(TableStore, method, lost)
        try:
            process_silver(spark, layout, job)
        except ConnectionError:
            continue
        finally:
            TableStore.write, TableStore._commit = write, commit
        raise AssertionError("the run did not fail")
    for _ in range(2):
        process_silver(spark, layout, job)
    return layout


@registry.query("silver_retry", f"{_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL")
def silver_retry(spark, sf_dir):
    """Whatever step a run failed at, and however often it came: its valid rows once."""
    return _silver_rows(spark, _retried(spark, sf_dir))


@registry.query(
    "quarantine_retry",
    f"{_STAMPED}, {ISSUES_SQL} AS data_quality_issues FROM dirty WHERE {ISSUES_SQL} IS NOT NULL",
)
def quarantine_retry(spark, sf_dir):
    """The same of its invalid rows."""
    rows = spark.read.parquet(_retried(spark, sf_dir).quarantine_path("events"))
    return naive(rows, "bronze_ingest_timestamp", "silver_process_timestamp")


@registry.query(
    "bronze_ingest",
    f"WITH dirty AS ({DIRTY_SQL}) SELECT *, {BRONZE_SQL}, 'landing/events' AS bronze_source_path FROM dirty",
)
def bronze_ingest(spark, sf_dir):
    layout = fresh_layout(spark)
    job = _bronze_job(sf_dir, layout, file_format="orc", partition_cols="event_type")
    ingest_bronze(spark, job)
    return naive(spark.read.orc(job.target_path), "bronze_ingest_timestamp")


@registry.query("small_ingest", f"SELECT *, {BRONZE_SQL} FROM events")
def small_ingest_csv(spark, sf_dir):
    """The small flavour stamps no source path."""
    layout, events = fresh_layout(spark), table(spark, sf_dir, "events")
    job = _bronze_job(sf_dir, layout, transforms=(), file_format="csv")
    small_ingest(spark, job)
    schema = f"{events.schema.toDDL()}, bronze_ingest_timestamp timestamp, bronze_ingest_date string, bronze_ingest_time string"
    return naive(read_source(spark, "csv", job.target_path, schema=schema), "bronze_ingest_timestamp")


@registry.query(
    "run_audit",
    f"""WITH dirty AS ({DIRTY_SQL}), n AS (SELECT count(*) AS total, count(*) FILTER (WHERE {ISSUES_SQL} IS NULL) AS good FROM dirty)
        SELECT 'bronze_ingest' AS job_name, 'SUCCEEDED' AS status, total AS rows_read, 6 AS column_count,
               total AS rows_written, CAST(NULL AS BIGINT) AS rows_valid, CAST(NULL AS BIGINT) AS rows_invalid FROM n
        UNION ALL SELECT 'silver_process', 'SUCCEEDED', total, 10, good, good, total - good FROM n""",
)
def run_audit(spark, sf_dir):
    _, log = _chain(spark, sf_dir)
    return run_metrics(log.runs()).select(
        "job_name",
        "status",
        "rows_read",
        "column_count",
        "rows_written",
        "rows_valid",
        "rows_invalid",
    )


def _landing(spark, sf_dir, layout):
    """All events as two deliveries: a function that makes the next one arrive."""
    events, path = table(spark, sf_dir, "events"), layout.bronze_path("landing")
    early = F.coalesce(F.col("value") < 10, F.lit(False))
    deliveries = iter([events.filter(early), events.filter(~early)])
    ingest = IncrementalIngest(
        spark, path, "parquet", events.schema, layout.bronze_path("events"), source_label="landing/events"
    )
    return ingest, lambda: write_dataset(next(deliveries), path, "parquet")


_LANDED = f"SELECT *, {BRONZE_SQL}, 'landing/events' AS bronze_source_path FROM events"


@registry.query("incremental_ingest", _LANDED)
def incremental_ingest(spark, sf_dir):
    """Two deliveries and an idle rerun: every event exactly once."""
    ingest, deliver = _landing(spark, sf_dir, fresh_layout(spark))
    deliver()
    ingest.run(RUN_TS)
    deliver()
    ingest.run(RUN_TS)
    ingest.run(RUN_TS)
    return naive(ingest.read(), "bronze_ingest_timestamp")


@registry.query("incremental_late", _LANDED)
def incremental_late(spark, sf_dir):
    """The second delivery's files look 30 days older than the first's: every event exactly once."""
    layout = fresh_layout(spark)
    ingest, deliver = _landing(spark, sf_dir, layout)
    deliver()
    ingest.run(RUN_TS)
    first = set(ingest.folders.files(ingest.source_path))
    deliver()
    ingest.folders.backdate(ingest.source_path, set(ingest.folders.files(ingest.source_path)) - first, days=30)
    ingest.run(RUN_TS)
    return naive(ingest.read(), "bronze_ingest_timestamp")


@registry.query("incremental_partitioned", _LANDED)
def incremental_partitioned(spark, sf_dir):
    """Two deliveries into partitions."""
    layout = fresh_layout(spark)
    ingest, deliver = _landing(spark, sf_dir, layout)
    ingest.partition_cols = ["event_type"]
    deliver()
    ingest.run(RUN_TS)
    deliver()
    ingest.run(RUN_TS)
    return naive(ingest.read(), "bronze_ingest_timestamp")


@registry.query("incremental_table", _LANDED)
def incremental_table(spark, sf_dir):
    """Two deliveries into a table; the second's batch fails after its append and comes again."""
    layout = fresh_layout(spark)
    files, deliver = _landing(spark, sf_dir, layout)
    ingest = IncrementalTable(
        spark, TableStore(spark, layout), "events", files.source_path, files.fmt, files.schema, f"{files.root}-table",
        options=files.options, partition_cols=["event_type"], transforms=files.transforms, source_label=files.source_label,
    )
    deliver()
    ingest.run(RUN_TS)
    deliver()
    append = ingest.store.append

    def lost(*args, **kwargs):
        append(*args, **kwargs)
        raise ConnectionError("lost")

    ingest.store.append = lost
    try:
        ingest.run(RUN_TS)
    except PySparkException:
        ingest.store.append = append
    ingest.run(RUN_TS)
    return naive(ingest.read(), "bronze_ingest_timestamp")


@registry.query("bookmark_reset", f"{_LANDED} UNION ALL {_LANDED}")
def bookmark_reset(spark, sf_dir):
    """After a reset everything is taken once more."""
    ingest, deliver = _landing(spark, sf_dir, fresh_layout(spark))
    deliver()
    deliver()
    ingest.run(RUN_TS)
    ingest.reset()
    ingest.run(RUN_TS)
    return naive(ingest.read(), "bronze_ingest_timestamp")


def _split_landing(spark, sf_dir):
    """The bronze ingest of `_landing` with blanked cells, and the silver step behind it."""
    layout = fresh_layout(spark)
    ingest, deliver = _landing(spark, sf_dir, layout)
    ingest.transforms = (blank_some,)
    deliver()
    ingest.run(RUN_TS)
    bronze = ingest.read()
    sides = incremental_split(
        spark,
        f"{ingest.root}/g0/data",
        "parquet",
        bronze.schema,
        layout.table_path("events"),
        source_label="bronze/events",
    )
    for side in sides:
        side.run(RUN_TS)
    deliver()
    ingest.run(RUN_TS)
    for side in sides:
        side.run(RUN_TS)
        side.run(RUN_TS)
    return tuple(naive(side.read(), "bronze_ingest_timestamp", "silver_process_timestamp") for side in sides)


@registry.query("incremental_valid", f"{_STAMPED} FROM dirty WHERE {ISSUES_SQL} IS NULL")
def incremental_valid(spark, sf_dir):
    return _split_landing(spark, sf_dir)[0]


@registry.query(
    "incremental_invalid",
    f"{_STAMPED}, {ISSUES_SQL} AS data_quality_issues FROM dirty WHERE {ISSUES_SQL} IS NOT NULL",
)
def incremental_invalid(spark, sf_dir):
    return _split_landing(spark, sf_dir)[1]
