"""S12, S13, P4, F1, L1, A1, P6."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.functions.lineage import apply_transforms
from lodeworks.operators.scans import scan
from lodeworks.queries.base import RUN_TS, Registry, fresh_store, naive, table
from lodeworks.sources.samples import sample_columns

registry = Registry()

_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity"]
_PREDICATE = "l_returnflag = 'A' AND l_quantity >= 40"
_SCAN = f"SELECT {', '.join(_COLUMNS)} FROM lineitem WHERE {_PREDICATE}"


@registry.query("scan_project_filter", _SCAN)
def scan_project_filter(spark, sf_dir):
    return scan(table(spark, sf_dir, "lineitem"), _COLUMNS, _PREDICATE)


@registry.query("table_scan", _SCAN)
def table_scan(spark, sf_dir):
    """The same scan over a stored table, where the flag is a partition and prunes folders."""
    store = fresh_store(spark)
    store.append("lineitem", table(spark, sf_dir, "lineitem"), ["l_returnflag"])
    return store.read("lineitem", _COLUMNS, _PREDICATE)


@registry.query("scan_limit", "SELECT least(count(*), 100) AS n FROM lineitem")
def scan_limit(spark, sf_dir):
    """Which rows a limit keeps is open, so their number is reported."""
    return scan(table(spark, sf_dir, "lineitem"), _COLUMNS, limit=100).agg(F.count(F.lit(1)).alias("n"))


@registry.query("row_column_count", "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem")
def row_column_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(lines.columns)).alias("column_count"))


@registry.query(
    "sample_rows",
    f"""SELECT c_custkey AS id, concat('Name ', c_custkey) AS name, c_custkey * 10 AS value,
        CAST(TIMESTAMP '{RUN_TS}' AS DATE) AS date, TIMESTAMP '{RUN_TS}' AS timestamp FROM customer""",
)
def sample_rows(spark, sf_dir):
    return naive(sample_columns(table(spark, sf_dir, "customer"), "c_custkey", RUN_TS), "timestamp")


@registry.query(
    "transform_hook",
    """SELECT event_id, ts, user_id, upper(event_type) AS event_type, value, props,
       value >= 10 AS is_large FROM events""",
)
def transform_hook(spark, sf_dir):
    return apply_transforms(
        table(spark, sf_dir, "events"),
        [
            lambda df: df.withColumn("event_type", F.upper("event_type")),
            lambda df: df.withColumn("is_large", F.col("value") >= 10),
        ],
    )
