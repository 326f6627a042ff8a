"""P1-P3, P6, E1-E6, A5, A6."""

from __future__ import annotations

import glob
import os
from dataclasses import replace
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from lodeworks.errors import PipelineError
from lodeworks.functions.lineage import normalise_ingest_timestamp, stamp_bronze, stamp_silver
from lodeworks.operators import quality
from lodeworks.operators.audit import AuditLog, RunAudit, run_history, run_metrics
from lodeworks.operators.tables import TableStore
from lodeworks.plans.jobs import BronzeJob, SilverJob, bronze_to_silver, ingest_bronze, process_silver, small_ingest
from lodeworks.sources import inventory
from lodeworks.storage import Folders
from tests.conftest import rows

RUN_TS = "2024-06-01 12:34:56"


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    spark.createDataFrame([(1, "A", 10), (2, None, 20), (3, "C", None)], "id int, name string, value int").write.csv(
        path, header=True
    )
    return path


@pytest.fixture
def log(spark, layout):
    return AuditLog(spark, layout.audit_path)


def jobs(landing, layout, fmt="parquet", **silver):
    target = layout.bronze_path("t")
    return (
        BronzeJob("csv", landing, target, fmt, run_ts=RUN_TS),
        SilverJob(target, fmt, "t", run_ts=RUN_TS, **silver),
    )


def test_bronze_stamp(spark):
    got = stamp_bronze(spark.createDataFrame([(1, "old")], "id int, bronze_ingest_date string"), "src", RUN_TS)
    assert dict(got.dtypes)["bronze_ingest_timestamp"] == "timestamp"
    assert got.first().asDict() == {
        "id": 1,
        "bronze_ingest_date": "2024-06-01",
        "bronze_ingest_timestamp": datetime(2024, 6, 1, 12, 34, 56),
        "bronze_ingest_time": "12-34-56",
        "bronze_source_path": "src",
    }


def test_aware_clock_keeps_its_instant(spark):
    at = datetime(2024, 6, 1, 12, 0, 0, 250, tzinfo=timezone.utc)
    got = stamp_bronze(spark.range(1), "s", at).select(F.unix_micros("bronze_ingest_timestamp").alias("us")).first()
    assert got.us == int(at.timestamp()) * 1_000_000 + 250


def test_clock_defaults_to_now(spark):
    df = stamp_silver(spark.range(1), "s")
    age = df.select(F.unix_timestamp() - F.unix_timestamp("silver_process_timestamp")).first()[0]
    assert abs(age) < 60


def test_ingest_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.678901Z",), ("nope",), (None,)], "bronze_ingest_timestamp string")
    got = rows(normalise_ingest_timestamp(df))
    assert got == [(datetime(2024, 1, 2, 3, 4, 5, 678901),), (None,), (None,)]
    assert normalise_ingest_timestamp(spark.range(1)).columns == ["id"]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_chain(spark, layout, store, log, landing, fmt):
    first, second = bronze_to_silver(spark, layout, *jobs(landing, layout, fmt), log)
    assert (first.rows_read, first.column_count, first.rows_written) == (3, 3, 3)
    assert (second.rows_read, second.rows_valid, second.rows_invalid) == (3, 1, 2)
    silver = store.read("t")
    assert rows(silver.select("id", "name", "value")) == [(1, "A", 10)]
    assert dict(silver.dtypes)["bronze_ingest_timestamp"] == "timestamp"
    assert silver.first().bronze_ingest_timestamp == datetime(2024, 6, 1, 12, 34, 56)
    assert silver.first().silver_source_path == layout.bronze_path("t")
    bad = spark.read.parquet(layout.quarantine_path("t"))
    assert rows(bad.select("id", quality.ISSUES)) == [(2, "Null value in name"), (3, "Null value in value")]


def test_chain_refuses_unrelated_jobs(spark, layout, landing):
    bronze, _ = jobs(landing, layout)
    with pytest.raises(PipelineError):
        bronze_to_silver(spark, layout, bronze, SilverJob("/elsewhere", "parquet", "t"))


def test_clean_input_leaves_no_quarantine(spark, layout, store, landing):
    bronze, silver = jobs(landing, layout, transforms=[lambda df: df.fillna({"name": "?", "value": 0})])
    _, run = bronze_to_silver(spark, layout, bronze, silver)
    assert (run.rows_valid, run.rows_invalid) == (3, 0)
    assert not os.path.exists(layout.quarantine_path("t"))


@pytest.mark.parametrize("partition_cols", [None, "name"])
@pytest.mark.parametrize("kept", ["false", "id = 2"])
def test_no_valid_rows(spark, layout, store, landing, kept, partition_cols):
    bronze, silver = jobs(landing, layout, partition_cols=partition_cols)
    _, run = bronze_to_silver(spark, layout, replace(bronze, transforms=[lambda df: df.filter(kept)]), silver)
    n = 0 if kept == "false" else 1
    assert (run.rows_read, run.rows_valid, run.rows_invalid) == (n, 0, n)
    assert store.read("t").count() == 0
    assert os.path.exists(layout.quarantine_path("t")) == bool(n)


@pytest.mark.parametrize("switch,checked", [(True, True), ("TRUE", True), ("false", False), ("yes", False), (False, False)])
def test_bypass(spark, layout, store, landing, switch, checked):
    _, run = bronze_to_silver(spark, layout, *jobs(landing, layout, quality_checks=switch))
    assert store.read("t").count() == (1 if checked else 3)
    assert run.rows_valid == (1 if checked else None)
    assert os.path.exists(layout.quarantine_path("t")) == checked


def test_staged_split_of_unrepeatable_transforms(spark, layout, store, landing):
    coin = lambda df: df.withColumn("value", F.when(F.rand() < 0.5, 1))
    bronze, silver = jobs(landing, layout, transforms=[coin], stage=True)
    _, run = bronze_to_silver(spark, layout, bronze, silver)
    kept = {r.id for r in store.read("t").collect()}
    dropped = set()
    if run.rows_invalid:
        dropped = {r.id for r in spark.read.parquet(layout.quarantine_path("t")).collect()}
    assert kept | dropped == {1, 2, 3} and not kept & dropped
    assert not glob.glob(spark.conf.get("spark.checkpoint.dir") + "/lodeworks-stage-*")


def test_rows_read_are_the_source_rows(spark, layout, store, landing):
    bronze, silver = jobs(landing, layout, transforms=[lambda df: df.filter("id = 1")])
    first, second = bronze_to_silver(spark, layout, replace(bronze, transforms=[lambda df: df.union(df)]), silver)
    assert (first.rows_read, first.rows_written) == (3, 6)
    assert (second.rows_read, second.rows_valid, second.rows_invalid) == (6, 2, 0)


def test_silver_modes_and_partitions(spark, layout, store, landing):
    bronze, silver = jobs(landing, layout, partition_cols="name", quality_checks=False)
    bronze_to_silver(spark, layout, bronze, silver)
    process_silver(spark, layout, silver)
    assert store.read("t").count() == 6 and store.partition_columns("t") == ["name"]
    process_silver(spark, layout, replace(silver, mode="overwrite"))
    assert store.read("t").count() == 3


def test_bronze_appends_on_rerun(spark, layout, landing):
    job, _ = jobs(landing, layout)
    for _ in range(2):
        ingest_bronze(spark, job)
    assert spark.read.parquet(job.target_path).count() == 6


@pytest.mark.parametrize("change", [{"source_type": "xml"}, {"file_format": "avro"}])
def test_bad_format_fails_before_reading(spark, layout, log, change):
    job = BronzeJob(**{"source_type": "csv", "source_path": "/nowhere", "target_path": layout.bronze_path("t"), **change})
    with pytest.raises(ValueError, match=next(iter(change.values()))):
        ingest_bronze(spark, job, log)
    assert not os.path.exists(job.target_path)
    run = log.runs().first()
    assert (run.status, run.error_type, run.rows_read) == ("FAILED", "ValueError", None)


def test_small_ingest(spark, layout, landing):
    job, _ = jobs(landing, layout, "json")
    small_ingest(spark, job)
    got = spark.read.json(job.target_path)
    assert "bronze_source_path" not in got.columns and "bronze_ingest_time" in got.columns
    with pytest.raises(ValueError, match="orc"):
        small_ingest(spark, BronzeJob("csv", landing, job.target_path, "orc"))


def test_audit(spark, layout, log, landing):
    assert log.runs().count() == 0
    bronze_to_silver(spark, layout, *jobs(landing, layout), log)
    with pytest.raises(Exception):
        ingest_bronze(spark, BronzeJob("parquet", "/nowhere", layout.bronze_path("x")), log)
    assert rows(log.runs().select("job_name", "status")) == [
        ("bronze_ingest", "FAILED"), ("bronze_ingest", "SUCCEEDED"), ("silver_process", "SUCCEEDED"),
    ]
    assert run_history(log.runs(), "bronze_ingest").count() == 2
    assert log.runs().filter("params['table_name'] = 't'").count() == 1
    assert log.runs().filter("capacity > 0 AND attempt = 1").count() == 3
    assert run_metrics(log.runs()).filter("duration_seconds > 0").count() == 3


def test_duration_needs_both_ends(spark, log):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    log.append(RunAudit("j", start_time=at, end_time=at.replace(second=2, microsecond=500_000)))
    log.append(RunAudit("k", start_time=at))
    got = run_metrics(log.runs()).select("job_name", "duration_seconds")
    assert rows(got) == [("j", 2.5), ("k", None)]


def _lose_first_tries(df):
    """Every task that runs this fails twice before it gets through."""

    @F.pandas_udf("boolean")
    def shaky(s: pd.Series) -> pd.Series:
        if TaskContext.get().attemptNumber() < 2:
            raise RuntimeError("lost")
        return s.notna()

    return df.filter(shaky("id"))


@pytest.mark.parametrize("partition_cols", [None, "name"])
def test_lost_tasks_change_neither_rows_nor_counts(spark, layout, store, landing, partition_cols):
    bronze, silver = jobs(landing, layout, partition_cols=partition_cols, transforms=[_lose_first_tries])
    first, second = bronze_to_silver(spark, layout, replace(bronze, transforms=[_lose_first_tries]), silver)
    assert (first.rows_read, first.rows_written) == (3, 3)
    assert (second.rows_read, second.rows_valid, second.rows_invalid) == (3, 1, 2)
    assert (store.read("t").count(), spark.read.parquet(layout.quarantine_path("t")).count()) == (1, 2)


def test_outputs(spark, layout, landing):
    bronze, silver = jobs(landing, layout, transforms=[lambda df: df.fillna({"name": "?", "value": 0})])
    bronze_to_silver(spark, layout, bronze, silver)
    os.makedirs(layout.bronze_path("empty"))
    outputs = [
        ("bronze", bronze.target_path),
        ("table", layout.table_path("t")),
        ("quarantine", layout.quarantine_path("t")),
        ("empty", layout.bronze_path("empty")),
    ]
    got = {r.output: r.is_empty for r in inventory.check_outputs(spark, outputs).collect()}
    assert got == {"bronze": False, "table": False, "quarantine": True, "empty": True}
    assert inventory.check_outputs(spark, []).count() == 0


@pytest.mark.parametrize("mode", ["append", "overwrite"])
@pytest.mark.parametrize("parts", ["", "p"])
@pytest.mark.parametrize("kind", ["true", "false", "null"])
def test_constant_rules_lose_no_row(spark, layout, tmp_path, kind, parts, mode):
    source = str(tmp_path / "bronze")
    spark.range(20).select("id", (F.col("id") % 3).cast("string").alias("p")).write.parquet(source)
    rules = [] if kind == "null" else [quality.Rule("always", kind)]
    blank = [lambda df: df.withColumn("gone", F.lit(None).cast("string"))] if kind == "null" else []
    job = SilverJob(source, "parquet", "t", parts, rules=rules, transforms=blank, mode=mode)
    for run in (1, 2):
        audit = process_silver(spark, layout, job)
        good = 20 if kind == "false" else 0
        assert (audit.rows_valid, audit.rows_invalid) == (good, 20 - good)
        kept = good * (run if mode == "append" else 1)
        assert TableStore(spark, layout).read("t").count() == kept
        if not good:
            assert spark.read.parquet(layout.quarantine_path("t")).count() == 20 * run


def test_empty_text_through_csv_stays_valid(spark, layout, tmp_path):
    spark.createDataFrame([(1, ""), (2, "a\nb"), (3, None)], "id int, v string").write.parquet(str(tmp_path / "in"))
    bronze = BronzeJob("parquet", str(tmp_path / "in"), layout.bronze_path("t"), "csv")
    stamped = "id int, v string, bronze_ingest_timestamp string, bronze_ingest_date string, bronze_ingest_time string, bronze_source_path string"
    _, audit = bronze_to_silver(spark, layout, bronze, SilverJob(bronze.target_path, "csv", "t", schema=stamped))
    assert (audit.rows_valid, audit.rows_invalid) == (2, 1)
    assert rows(TableStore(spark, layout).read("t", ["id", "v"])) == [(1, ""), (2, "a\nb")]


@pytest.mark.parametrize("lost", ["write", "_commit", "_write"])
@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_a_run_that_failed_is_done_over(spark, layout, store, landing, log, monkeypatch, lost, mode):
    bronze, silver = jobs(landing, layout, run_id="a/b c", mode=mode)
    ingest_bronze(spark, bronze)
    for _ in range(2):
        with monkeypatch.context() as m:
            m.setattr(TableStore, lost, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                process_silver(spark, layout, silver, log)
        assert not store.exists("t")
    for _ in range(2):
        audit = process_silver(spark, layout, silver, log)
        assert (audit.rows_read, audit.rows_valid, audit.rows_invalid) == (3, 1, 2)
        assert (store.read("t").count(), spark.read.parquet(layout.quarantine_path("t")).count()) == (1, 2)
    process_silver(spark, layout, replace(silver, run_id="later"), log)
    assert store.read("t").count() == (2 if mode == "append" else 1)
    assert spark.read.parquet(layout.quarantine_path("t")).count() == 4
    process_silver(spark, layout, replace(silver, run_id=None), log)
    assert spark.read.parquet(layout.quarantine_path("t")).count() == 6


def test_a_quarantine_that_is_half_there_is_replaced(spark, layout, store, landing, monkeypatch):
    bronze, silver = jobs(landing, layout, run_id="r")
    ingest_bronze(spark, bronze)
    real = Folders.move

    def half(self, path, to):
        real(self, path, to)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Folders, "move", half)
        with pytest.raises(OSError):
            process_silver(spark, layout, silver)
    process_silver(spark, layout, silver)
    assert (store.read("t").count(), spark.read.parquet(layout.quarantine_path("t")).count()) == (1, 2)


def test_a_run_without_checks_is_written_once(spark, layout, store, landing):
    bronze, silver = jobs(landing, layout, run_id="r", quality_checks="false")
    ingest_bronze(spark, bronze)
    for _ in range(2):
        audit = process_silver(spark, layout, silver)
        assert (audit.rows_read, audit.rows_written, audit.rows_invalid) == (3, 3, None)
    assert store.read("t").count() == 3
