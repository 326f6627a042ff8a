"""What the physical plans must and must not do at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lodeworks.operators import merge as m
from lodeworks.operators import quality
from lodeworks.queries import QUERIES
from lodeworks.sinks.writers import cluster_for
from lodeworks.sources import inventory

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    old = {}

    def put(**settings):
        for key, value in settings.items():
            key = "spark.sql." + key.replace("__", ".")
            old.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, n, share=3):
    """Rows of which every third has key 0."""
    k = F.when(F.col("id") % share == 0, 0).otherwise(F.col("id"))
    return spark.range(0, n, 1, 16).select(k.alias("k"), F.col("id").cast("string").alias("v"))


def skewed(conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )


def test_source_is_cut_to_one_row_per_key_before_its_shuffle(spark):
    source = hot(spark, 1000).withColumn("seq", F.col("v"))
    text = plan_of(m.last_per_key(source, ["k"], ["seq"], ["v"]))
    assert text.index("max(") < text.index("Exchange") < text.index("partial_max(")
    assert "Window" not in text


def test_hot_destination_key_is_split(spark, conf):
    skewed(conf)
    dest = hot(spark, 60_000)
    source = spark.range(0, 30_000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    got = m.update_rows(source, dest, ["k"])
    new = sum(r.v == "new" for r in got.collect())
    assert "skew=true" in plan_of(got)
    assert new == dest.join(source, "k", "left_semi").count()


def test_hot_new_key_is_split(spark, conf):
    skewed(conf)
    source = hot(spark, 60_000)
    dest = spark.range(1, 30_000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    got = m.insert_rows(source, dest, ["k"])
    inserted = len(got.collect())
    assert "SortMergeJoin(skew=true)" in plan_of(got) and "LeftAnti" in plan_of(got)
    assert inserted == source.join(dest, "k", "left_anti").count()


def test_whole_merge_splits_hot_keys(spark, conf, tmp_path):
    skewed(conf)
    dest = hot(spark, 60_000)
    source = hot(spark, 60_000).withColumn("k", F.col("k") + F.when(F.col("k") > 40_000, 1_000_000).otherwise(0))
    got = m.merge(source, dest, ["k"], order_by=["v"])
    assert len(got.collect()) > 60_000
    assert plan_of(got).count("skew=true") >= 2


def test_small_source_is_broadcast_and_destination_not_shuffled(spark):
    dest = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    source = dest.limit(10).select("l_orderkey", F.lit(0.0).alias("l_tax")).distinct()
    text = plan_of(m.update_rows(source, dest, ["l_orderkey"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_quality_is_one_narrow_stage(spark):
    df = spark.read.parquet(f"{SF_DIR}/events.parquet")
    for one in (quality.annotate(df), *quality.split(df), quality.violations(df, ["event_id"])):
        assert "Exchange" not in plan_of(one)


def test_invalid_rows_are_filtered_at_the_scan(spark):
    df = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    text = plan_of(quality.invalid_rows(df))
    assert "PushedFilters: [Or(" in text and "IsNull(c_custkey)" in text


def test_scan_prunes_partitions_and_columns(spark):
    text = plan_of(QUERIES["table_scan"](spark, SF_DIR))
    # The table's layers are partitions too.
    assert re.search(r"PartitionFilters: \[[^\]]*__layer[^\]]*isnotnull\(l_returnflag|PartitionFilters: \[isnotnull\(l_returnflag[^\]]*__layer", text)
    assert "GreaterThanOrEqual(l_quantity,40.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text


def test_inventory_opens_no_file(spark):
    text = plan_of(inventory.list_files(spark, SF_DIR))
    assert "content" not in text


def test_hot_partition_value_becomes_many_files(spark, conf, tmp_path):
    conf(adaptive__advisoryPartitionSizeInBytes="20KB")
    df = hot(spark, 60_000).withColumn("p", F.when(F.col("k") == 0, "hot").otherwise("cold"))
    cluster_for(df, ["p"]).write.partitionBy("p").parquet(str(tmp_path / "t"))
    files = inventory.list_files(spark, str(tmp_path / "t"))
    assert files.filter("relative_path LIKE 'p=hot/%'").count() > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_no_clustering_shuffle_without_adaptive_execution(spark, conf):
    df = hot(spark, 100)
    assert "REBALANCE" in plan_of(cluster_for(df, ["k"]))
    conf(adaptive__enabled="false")
    assert "Exchange" not in plan_of(cluster_for(df, ["k"]))


def test_no_cross_join_anywhere(spark):
    for name in ("merge_upsert", "merge_counts", "table_stats", "dq_summary", "expected_files"):
        text = plan_of(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
