"""S1-S7, K1-K7."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from lodeworks.layout import parse_partition_cols
from lodeworks.sinks import writers
from lodeworks.sinks.writers import write_dataset
from lodeworks.sources import readers
from lodeworks.sources.readers import SILVER_SOURCES, SMALL_SOURCES, read_source
from lodeworks.sources.samples import sample_rows
from tests.conftest import rows


@pytest.fixture
def three(spark):
    return spark.createDataFrame([(1, "A", 10), (2, "B", 20), (3, "C", 30)], "id int, name string, value int")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_round_trip(spark, tmp_path, three, fmt):
    path = str(tmp_path / fmt)
    assert write_dataset(three, path, fmt).get["rows"] == 3
    got = read_source(spark, fmt, path)
    assert rows(got.select("id", "name", "value")) == rows(three)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_formats_keep_microseconds(spark, tmp_path, fmt):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05.678901' AS a, timestamp_ntz'2024-01-02 03:04:05.000001' AS b")
    path = str(tmp_path / fmt)
    write_dataset(df, path, fmt)
    assert rows(read_source(spark, fmt, path, schema=df.schema)) == rows(df)


def test_csv_infers_types(spark, tmp_path):
    path = str(tmp_path / "c")
    os.makedirs(path)
    with open(f"{path}/f.csv", "w") as f:
        f.write("i,l,d,s,t\n1,99999999999,1.5,x,2024-01-02 03:04:05\n,,,,\n")
    got = read_source(spark, "csv", path)
    assert [t for _, t in got.dtypes] == ["int", "bigint", "double", "string", "timestamp"]
    assert rows(got)[1] == (None,) * 5


def test_csv_options_pass_through(spark, tmp_path, three):
    path = str(tmp_path / "c")
    write_dataset(three, path, "csv", options={"sep": "|", "header": "false"})
    got = read_source(spark, "csv", path, {"sep": "|", "header": "false"})
    assert got.columns == ["_c0", "_c1", "_c2"] and got.count() == 3


def test_csv_text_safe(spark, tmp_path):
    text = ["a\nb", ' "quoted", ', "back\\slash\\", "", None, "tab\tand\r\nreturn", '"', '\\"']
    df = spark.createDataFrame(list(enumerate(text)), "id int, s string")
    path = str(tmp_path / "c")
    write_dataset(df, path, "csv", )
    assert rows(read_source(spark, "csv", path, schema=df.schema)) == rows(df)


TEXTS = [
    "a\nb", "a\r\nb", "\n", "", " ", " pad ", None, "\\N", "\\n", "\ue000", "\ue000n", "\ue000\n\ue000", 'say "x"', '"', "a,b", "\\",
    "\u2028", "\x85", "null",
]


@pytest.mark.parametrize("columns", [1, 2])
def test_csv_keeps_text_by_default(spark, tmp_path, columns):
    """Rows of one cell too, which may look like empty lines; one row stays one line of the file."""
    df = spark.createDataFrame([(t, t)[:columns] for t in TEXTS], ", ".join(f"c{i} string" for i in range(columns)))
    path = str(tmp_path / "t")
    write_dataset(df.coalesce(1), path, "csv")
    assert rows(read_source(spark, "csv", path, schema=df.schema)) == rows(df)
    assert len(spark.read.text(path, lineSep="\n").collect()) == len(TEXTS) + 1


def test_csv_partition_values_keep_text(spark, tmp_path):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS) if t], "id int, v string, p string")
    path = str(tmp_path / "t")
    write_dataset(df, path, "csv", ["p"])
    assert rows(read_source(spark, "csv", path, schema=df.schema).select("id", "v")) == rows(df.select("id", "v"))


def test_json_lines_and_top_level_array(spark, tmp_path):
    path = str(tmp_path / "j")
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write('[{"id": 1, "n": {"x": [1, 2]}}, {"id": 2}]')
    with open(f"{path}/b.json", "w") as f:
        f.write('{"id": 3}\n{"id": 4}\n')
    got = read_source(spark, "json", path)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4]
    assert dict(got.dtypes)["n"] == "struct<x:array<bigint>>"


def test_parquet_merge_schema_option(spark, tmp_path, three):
    path = str(tmp_path / "p")
    write_dataset(three, path, "parquet")
    write_dataset(three.withColumnRenamed("value", "other"), path, "parquet")
    assert set(read_source(spark, "parquet", path, {"mergeSchema": "true"}).columns) == {"id", "name", "value", "other"}


@pytest.mark.parametrize("allowed", [SILVER_SOURCES, SMALL_SOURCES])
def test_source_formats_are_per_layer(spark, allowed):
    for fmt in {"avro", "jdbc", "orc"} - set(allowed):
        with pytest.raises(ValueError, match=fmt):
            read_source(spark, fmt, "/nowhere", allowed=allowed)


def test_unknown_sink_writes_nothing(tmp_path, three):
    with pytest.raises(ValueError, match="avro"):
        write_dataset(three, str(tmp_path / "x"), "avro")
    assert not (tmp_path / "x").exists()


def test_csv_refuses_nested_columns(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, array(1, 2) AS xs")
    with pytest.raises(ValueError, match="xs"):
        write_dataset(df, str(tmp_path / "x"), "csv")
    assert not (tmp_path / "x").exists()


class _Recorder:
    """Stands in for a session: notes what the reader is asked for."""

    def __init__(self):
        self.calls = []
        self.read = self

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return note


def test_jdbc_takes_everything_from_options():
    session = _Recorder()
    options = {"url": "jdbc:any", "dbtable": "t", "partitionColumn": "id", "numPartitions": "8"}
    read_source(session, "jdbc", "ignored", options)
    assert session.calls == [("format", ("jdbc",), {}), ("options", (), options), ("load", (), {})]


def test_jdbc_reaches_spark(spark):
    with pytest.raises(PySparkException):
        read_source(spark, "jdbc", None, {"dbtable": "t"})


def test_partition_columns_from_text():
    assert parse_partition_cols("a, b,,") == ["a", "b"]
    assert parse_partition_cols("") == parse_partition_cols(None) == parse_partition_cols([]) == []


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_null_partition_value(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, p string")
    path = str(tmp_path / fmt)
    write_dataset(df, path, fmt, "p")
    assert rows(read_source(spark, fmt, path).select("id", "p")) == [(1, "x"), (2, None)]


def test_append_adds(spark, tmp_path, three):
    path = str(tmp_path / "p")
    for _ in range(2):
        write_dataset(three, path, "parquet")
    assert read_source(spark, "parquet", path).count() == 6


def test_sample_rows(spark):
    got = sample_rows(spark, 3, "2024-06-01 00:00:00")
    assert rows(got.select("id", "name", "value")) == [(1, "Name 1", 10), (2, "Name 2", 20), (3, "Name 3", 30)]
    assert got.first().timestamp == datetime(2024, 6, 1)
    assert dict(got.dtypes) == {"id": "bigint", "name": "string", "value": "bigint", "date": "date", "timestamp": "timestamp"}
    assert sample_rows(spark).count() == 1000
