"""Queries about files write them by more than one task."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.queries import ORACLE, QUERIES, files
from lodeworks.queries.base import one_task_each
from tests.differential import difference, open_tables

SF_DIR = "/root/testdata/sf0.01"


def test_one_task_each(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3] if i % 7 else None, i % 2) for i in range(200)], "i int, `p.x` string, q int")
    dealt = one_task_each(df, "p.x", "q").withColumn("task", F.spark_partition_id())
    assert dealt.select("i").distinct().count() == dealt.count() == 200
    per = {(r[0], r[1], r[2]) for r in dealt.select("`p.x`", "q", "task").collect()}
    assert len(per) == 8 and {task for *_, task in per} == set(range(8))


def test_folders_are_written_by_a_task_each(spark, monkeypatch):
    written = []
    real = files.write_dataset

    def seen(df, *args, **more):
        written.append(df.select("o_orderpriority", F.spark_partition_id()).distinct().collect())
        return real(df, *args, **more)

    monkeypatch.setattr(files, "write_dataset", seen)
    files.prefix_list(spark, SF_DIR)
    assert len({r[1] for r in written[0]}) == len(written[0]) == 5


def test_texts_are_written_in_files_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 40)
    listed = files.inventory.list_files(spark, files._texts_folder(spark, SF_DIR), ".txt")
    assert listed.count() >= 1000 / 40
    for name in ("binary_scan", "file_sizes"):
        assert difference(QUERIES[name](spark, SF_DIR), open_tables(SF_DIR), ORACLE[name]) is None


def test_texts_are_dealt_evenly(spark):
    sizes = [r[0] for r in files.inventory.list_files(spark, files._few_texts_folder(spark, SF_DIR), ".txt").select("length").collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4
