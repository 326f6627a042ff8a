"""S8-S11, A4 and the work folder."""

from __future__ import annotations

import os

import pytest

from lodeworks.errors import DataError, LakeError, PipelineError, ValidationError
from lodeworks.layout import LakeLayout
from lodeworks.sources import inventory
from lodeworks.storage import Folders, work_folder
from tests.conftest import rows

FILES = {"a/x.csv": b"12345", "a/b/y.csv": b"1", "c d/z.json": b"\x00\xff", "top.csv": b"abc", "p=a b/q.csv": b"7"}


def test_inventory(spark, tmp_path):
    root = tmp_path / "tree"
    for name, body in FILES.items():
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(body)
    root = str(root)
    listed = inventory.list_files(spark, root)
    assert rows(listed.select("relative_path", "length")) == sorted((k, len(v)) for k, v in FILES.items())
    assert inventory.list_files(spark, root, ".csv").count() == 4
    assert rows(inventory.list_prefixes(spark, root)) == [("a",), ("c d",), ("p=a b",)]
    assert {r.relative_path: bytes(r.content) for r in inventory.read_objects(spark, root).collect()} == FILES
    assert inventory.file_rollup(spark, root + "/").first() == (12, 5)
    wanted = spark.createDataFrame([("a/x.csv", 1), ("a/none.csv", 2)], "relative_path string, n int")
    assert rows(inventory.check_expected(spark, root, wanted)) == [("a/none.csv", 2, False), ("a/x.csv", 1, True)]


def test_empty_and_hidden_files_are_listed(spark, tmp_path):
    for name, body in {"_SUCCESS": b"", "d/DONE": b"", "d/data.csv": b"1", "_d/x": b"12", ".h": b"123", "e f/_x": b""}.items():
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_bytes(body)
    root = str(tmp_path)
    listed = rows(inventory.list_files(spark, root).select("relative_path", "length"))
    assert listed == [(".h", 3), ("_SUCCESS", 0), ("_d/x", 2), ("d/DONE", 0), ("d/data.csv", 1), ("e f/_x", 0)]
    assert rows(inventory.list_files(spark, root, "DONE").select("length")) == [(0,)]
    assert inventory.file_rollup(spark, root).first() == (6, 6)
    wanted = spark.createDataFrame([("d/DONE",), ("_SUCCESS",), ("d/NONE",)], "relative_path string")
    assert rows(inventory.check_expected(spark, root, wanted)) == [("_SUCCESS", True), ("d/DONE", True), ("d/NONE", False)]
    assert rows(inventory.list_prefixes(spark, root)) == [("_d",), ("d",), ("e f",)]


def test_rollup_of_an_empty_folder(spark, tmp_path):
    assert inventory.file_rollup(spark, str(tmp_path)).first() == (0, 0)


def test_layout_paths():
    layout = LakeLayout.under("s3a://bucket/lake/")
    assert layout.table_path("t") == "s3a://bucket/lake/silver/processed/t"
    assert layout.metadata_path("t") == "s3a://bucket/lake/silver/processed/t/_metadata"
    assert layout.quarantine_path("t") == "s3a://bucket/lake/silver/invalid/t"
    assert layout.bronze_path("d") == "s3a://bucket/lake/bronze/raw/d"
    assert (layout.table_format, layout.compression, layout.partition_cols) == ("parquet", "snappy", ())


def test_work_folder_is_below_the_shared_setting(spark):
    one, two = work_folder(spark), work_folder(spark)
    assert one != two and os.path.dirname(one) == spark.conf.get("spark.checkpoint.dir")


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None


def test_work_folder_is_refused_on_a_cluster_without_one():
    with pytest.raises(LakeError, match="spark.checkpoint.dir"):
        work_folder(_Cluster)


def test_errors():
    e = ValidationError("bad", source="s", table="t", column="c", validation_rule="not_null")
    assert isinstance(e, DataError)
    assert e.to_dict() == {
        "error_type": "ValidationError",
        "error_code": "VALIDATION_ERROR",
        "message": "bad",
        "details": {"source": "s", "table": "t", "column": "c", "validation_rule": "not_null"},
    }
    assert DataError("x").to_dict()["error_code"] == "DATA_ERROR"
    assert PipelineError("x", pipeline_name="p", stage="load").details == {"pipeline_name": "p", "stage": "load"}
    assert LakeError("x").error_code == "UNKNOWN_ERROR"


def test_bodies_of_empty_and_hidden_files(spark, tmp_path):
    bodies = {"_SUCCESS": b"", "d/DONE": b"", "d/data.csv": b"1", "_d/x.csv": b"12", ".h": b"\x00\xff", "e f/_x.csv": b"", "_d/_y": b"3"}
    for name, body in bodies.items():
        file = tmp_path / name
        file.parent.mkdir(exist_ok=True)
        file.write_bytes(body)
    got = inventory.read_objects(spark, str(tmp_path)).collect()
    assert {r.relative_path: bytes(r.content) for r in got} == bodies and len(got) == len(bodies)
    assert all(r.length == len(r.content) for r in got)
    some = inventory.read_objects(spark, str(tmp_path), ".csv").collect()
    assert {r.relative_path: bytes(r.content) for r in some} == {k: v for k, v in bodies.items() if k.endswith(".csv")}


@pytest.mark.parametrize("name", ["a; isDirectory=true; length=5", "path=b", "{c}", "d;e", "f, g", "h\ni"])
def test_names_that_look_like_a_status(spark, tmp_path, name):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / name).write_bytes(b"123")
    (tmp_path / "x" / "plain").write_bytes(b"1")
    folders = Folders(spark)
    assert sorted((n, d, size) for n, d, size, _ in folders.listing(str(tmp_path / "x"))) == sorted([(name, False, 3), ("plain", False, 1)])
    assert folders.children(str(tmp_path)) == ["x"] and folders.listing(str(tmp_path / "none")) == []
    assert folders.listing(str(tmp_path / "x" / "plain")) == []


def test_large_trees_are_listed_in_few_calls(spark, tmp_path, monkeypatch):
    """However many files a folder has, and with folders side by side."""
    for d in range(40):
        (tmp_path / f"d{d}" / "inner").mkdir(parents=True)
        for f in range(100):
            (tmp_path / f"d{d}" / "inner" / f"f{f}").touch()
    calls, real = [], spark._jvm._gateway_client.send_command

    def counted(command, *args, **kwargs):
        calls.append(command)
        return real(command, *args, **kwargs)

    monkeypatch.setattr(spark._jvm._gateway_client, "send_command", counted)
    found = [f for files in Folders(spark).walk(str(tmp_path)) for f in files]
    assert len(found) == 4000 and len(set(found)) == 4000
    assert len(calls) < 4000
    stamps = inventory.list_files(spark, str(tmp_path)).selectExpr("min(modificationTime) a", "max(modificationTime) b").first()
    times = [os.stat(p[0].removeprefix("file:")).st_mtime for p in found]
    assert abs(stamps.a.timestamp() - min(times)) < 1 and abs(stamps.b.timestamp() - max(times)) < 1
