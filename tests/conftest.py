"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodeworks.layout import LakeLayout  # noqa: E402
from lodeworks.operators.tables import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8,4]")  # a task may fail three times
        .appName("lodeworks-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return LakeLayout.under(str(tmp_path), database="db_" + tmp_path.name.replace("-", "_"))


@pytest.fixture
def store(spark, layout):
    return TableStore(spark, layout)


def rows(df, *order):
    """The rows as plain tuples, sorted with NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])
