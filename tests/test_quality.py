"""Q1-Q6 on hand-made frames."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from lodeworks.operators import quality
from tests.conftest import rows

SMALL = "id int, name string, val double, bronze_x string"


@pytest.fixture
def small(spark):
    return spark.createDataFrame([(1, "a", None, "m"), (2, None, None, "m"), (3, "c", 1.5, None)], SMALL)


def test_issues_in_column_order(small):
    got = {r.id: r.data_quality_issues for r in quality.annotate(small).collect()}
    assert got == {1: "Null value in val", 2: "Null value in name, Null value in val", 3: None}


def test_split_is_disjoint_and_whole(small):
    valid, invalid = quality.split(small)
    assert rows(valid) == [(3, "c", 1.5, None)]
    assert valid.columns == small.columns
    assert sorted(r.id for r in invalid.collect()) == [1, 2]
    assert valid.unionByName(invalid.drop(quality.ISSUES)).exceptAll(small).count() == 0


def test_no_business_columns(spark):
    df = spark.createDataFrame([(None, None), ("x", "y")], "bronze_a string, silver_b string")
    valid, invalid = quality.split(df)
    assert (valid.count(), invalid.count()) == (2, 0)
    assert quality.annotate(df).filter(F.col(quality.ISSUES).isNotNull()).count() == 0
    assert quality.violations(df, ["bronze_a"]).count() == 0


def test_nan_and_empty_text_are_not_null(spark):
    df = spark.createDataFrame([(float("nan"), "")], "x double, s string")
    assert quality.split(df)[0].count() == 1


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, `c ``d` string")
    assert [r.data_quality_issues for r in quality.invalid_rows(df).collect()] == ["Null value in c `d"]
    assert rows(quality.violations(df, ["a.b"])) == [(1, "c `d", "not_null")]


def test_existing_issue_column_is_replaced(spark):
    df = spark.createDataFrame([(1, "old")], "id int, data_quality_issues string")
    assert quality.annotate(df).first().data_quality_issues is None
    assert quality.valid_rows(df).columns == ["id"]


def test_rules_add_to_null_checks(small):
    rule = quality.Rule("val above 1", F.col("val") > 1, "val")
    assert quality.summary(small, [rule]).first() == (3, 0, 3)
    assert (3, "val", "val above 1") in rows(quality.violations(small, ["id"], [rule]))
    by_text = quality.Rule("val above 1", "val > 1")
    assert [r.data_quality_issues for r in quality.invalid_rows(small.filter("id = 3"), [by_text]).collect()] == ["val above 1"]


def test_summary(small):
    assert quality.summary(small).first() == (3, 1, 2)


@pytest.mark.parametrize("width", [200, 2000])
def test_wide_frames_plan_in_seconds(spark, width):
    df = spark.range(1).select(*[F.lit("x" if i else None).alias(f"c{i}") for i in range(width)])
    start = time.time()
    assert quality.annotate(df).first()[quality.ISSUES] == "Null value in c0"
    valid, invalid = quality.split(df)
    assert (valid.count(), invalid.count()) == (0, 1)
    assert time.time() - start < width / 20
