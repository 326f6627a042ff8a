"""B1, B2."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodeworks.errors import DataError
from lodeworks.streaming.incremental import IncrementalIngest, IncrementalTable, incremental_split
from tests.conftest import rows

SCHEMA = "id int, name string"


@pytest.fixture
def deliver(spark, tmp_path):
    """Let three more rows arrive as one CSV file."""

    def arrive(start):
        df = spark.range(start, start + 3).select(
            F.col("id").cast("int"), F.when(F.col("id") != start, F.col("id").cast("string")).alias("name")
        )
        df.coalesce(1).write.mode("append").csv(str(tmp_path / "in"), header=True)

    return arrive


def make(spark, tmp_path, **settings):
    return IncrementalIngest(spark, str(tmp_path / "in"), "csv", SCHEMA, str(tmp_path / "out"), **settings)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_each_file_once(spark, tmp_path, deliver):
    ingest = make(spark, tmp_path)
    with pytest.raises(DataError):
        ingest.read()
    deliver(0)
    ingest.run()
    assert ids(ingest.read()) == [0, 1, 2]
    ingest.run()
    assert ids(ingest.read()) == [0, 1, 2]
    deliver(3)
    make(spark, tmp_path).run()
    assert ids(ingest.read()) == [0, 1, 2, 3, 4, 5]


def test_reset_takes_everything_again(spark, tmp_path, deliver):
    ingest = make(spark, tmp_path)
    deliver(0)
    ingest.run()
    assert ingest.reset() == 1
    assert ids(ingest.read()) == [0, 1, 2]
    ingest.run()
    assert ids(ingest.read()) == [0, 0, 1, 1, 2, 2]


def test_failed_run_does_not_advance(spark, tmp_path, deliver):
    deliver(0)
    broken = make(spark, tmp_path, transforms=[lambda df: df.withColumn("id", F.raise_error(F.lit("no")).cast("int"))])
    with pytest.raises(PySparkException):
        broken.run()
    ingest = make(spark, tmp_path)
    ingest.run()
    assert ids(ingest.read()) == [0, 1, 2]


def test_backlog_in_small_batches(spark, tmp_path, deliver):
    for start in (0, 3, 6):
        deliver(start)
    ingest = make(spark, tmp_path, options={"maxFilesPerTrigger": "1"})
    ingest.run("2024-06-01 00:00:00")
    assert ids(ingest.read()) == list(range(9))
    assert rows(ingest.read().select("bronze_ingest_date").distinct()) == [("2024-06-01",)]


def test_same_rows_as_batch(spark, tmp_path, deliver):
    ingest = make(spark, tmp_path, partition_cols="name", sink_format="orc")
    for start in (0, 3):
        deliver(start)
        ingest.run()
    batch = spark.read.schema(SCHEMA).csv(str(tmp_path / "in"), header=True)
    assert rows(ingest.read().select("id", "name")) == rows(batch)


def test_split(spark, tmp_path, deliver):
    valid, invalid = incremental_split(spark, str(tmp_path / "in"), "csv", SCHEMA, str(tmp_path / "silver"))
    for start in (0, 3):
        deliver(start)
        valid.run()
        invalid.run()
    assert ids(valid.read()) == [1, 2, 4, 5]
    assert rows(invalid.read().select("id", "data_quality_issues")) == [(0, "Null value in name"), (3, "Null value in name")]
    assert "silver_process_date" in valid.read().columns


def test_unknown_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="jdbc"):
        IncrementalIngest(spark, "in", "jdbc", SCHEMA, str(tmp_path))
    with pytest.raises(ValueError, match="avro"):
        make(spark, tmp_path, sink_format="avro")


def test_files_with_old_times_are_taken(spark, tmp_path, deliver):
    ingest = make(spark, tmp_path)
    deliver(0)
    ingest.run()
    first = set(ingest.folders.files(ingest.source_path))
    deliver(3)
    ingest.folders.backdate(ingest.source_path, set(ingest.folders.files(ingest.source_path)) - first, days=30)
    ingest.run()
    assert ids(ingest.read()) == [0, 1, 2, 3, 4, 5]


def test_batches_are_clustered_by_partition(spark, tmp_path):
    """Four source files of fifty values each make about fifty files, not two hundred."""
    df = spark.range(400).select((F.col("id") % 50).cast("int").alias("id"), F.col("id").cast("string").alias("name"))
    df.repartition(4).write.csv(str(tmp_path / "in"), header=True)
    ingest = make(spark, tmp_path, partition_cols="ID", options={"maxFilesPerTrigger": "4"})
    ingest.run()
    got = ingest.read()
    assert got.count() == 400 and len(got.inputFiles()) <= 60


def test_text_from_csv_is_whole(spark, tmp_path):
    from lodeworks.sinks.writers import write_dataset

    df = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, None), (4, " x ")], SCHEMA)
    write_dataset(df, str(tmp_path / "in"), "csv")
    ingest = make(spark, tmp_path, sink_format="csv")
    ingest.run()
    assert rows(ingest.read().select("id", "name")) == rows(df)


def into_table(spark, store, tmp_path, **settings):
    return IncrementalTable(spark, store, "t", str(tmp_path / "in"), "csv", SCHEMA, str(tmp_path / "out"), **settings)


def test_into_a_table(spark, store, tmp_path, deliver):
    ingest = into_table(spark, store, tmp_path, partition_cols="name")
    with pytest.raises(DataError):
        ingest.read()
    deliver(0)
    ingest.run()
    ingest.run()
    deliver(3)
    into_table(spark, store, tmp_path).run()
    assert ids(store.read("t")) == [0, 1, 2, 3, 4, 5] and store.partition_columns("t") == ["name"]
    ingest.reset()
    ingest.run()
    assert ids(store.read("t")) == sorted([0, 1, 2, 3, 4, 5] * 2)


@pytest.mark.parametrize("before", [False, True])
def test_a_batch_that_failed_about_its_append_is_there_once(spark, store, tmp_path, deliver, before):
    ingest, append = into_table(spark, store, tmp_path, options={"maxFilesPerTrigger": "1"}), store.append
    for start in (0, 3, 6):
        deliver(start)
    calls = []

    def lost(*args, **kwargs):
        calls.append(1)
        if before and len(calls) == 2:
            raise OSError("lost")
        append(*args, **kwargs)
        if len(calls) == 2:
            raise OSError("lost")

    store.append = lost
    with pytest.raises(PySparkException):
        ingest.run()
    assert store.read("t").count() == (3 if before else 6)
    ingest.run()
    assert ids(store.read("t")) == list(range(9))
