"""J1-J4, U1. The source is every line item, read as a revision of its order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeworks.operators import merge as m
from lodeworks.queries.base import Registry, table

registry = Registry()

KEYS = ["o_orderkey"]
ORDER_BY = ["revised_at", "seq"]

# Covers several revisions per order, NULLs that overwrite, keys the orders lack (with
# duplicates) and a column the orders lack.
_REVISIONS = """
SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_orderkey + 10000000 ELSE l_orderkey END AS o_orderkey,
       l_shipdate AS revised_at, l_linenumber AS seq, l_extendedprice AS o_totalprice,
       nullif(l_returnflag, 'R') AS o_orderstatus, l_linestatus AS tag
FROM lineitem"""

WITH_LAST = f"""
WITH src AS ({_REVISIONS}),
last AS (SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY o_orderkey
         ORDER BY revised_at DESC NULLS LAST, seq DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderstatus DESC NULLS LAST) = 1)
"""
UPDATED = """
SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
       o.o_orderdate, o.o_orderpriority
FROM orders o LEFT JOIN last l ON o.o_orderkey IS NOT DISTINCT FROM l.o_orderkey"""
NEW = "NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey IS NOT DISTINCT FROM s.o_orderkey)"
MERGED = f"""{WITH_LAST}
SELECT *, CAST(NULL AS VARCHAR) AS tag FROM ({UPDATED})
UNION ALL
SELECT s.o_orderkey, NULL, s.o_orderstatus, s.o_totalprice, NULL, NULL, s.tag FROM src s WHERE {NEW}"""
COUNTS = f"""{WITH_LAST}
SELECT count(*) AS rows_updated, count(*) FILTER (WHERE NOT is_new) AS updated,
       count(*) FILTER (WHERE is_new) AS inserted
FROM (SELECT {NEW} AS is_new FROM src s)"""


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_orderkey + 10000000 ELSE l_orderkey END AS o_orderkey",
        "l_shipdate AS revised_at",
        "l_linenumber AS seq",
        "l_extendedprice AS o_totalprice",
        "nullif(l_returnflag, 'R') AS o_orderstatus",
        "l_linestatus AS tag",
    )


@registry.query("merge_upsert", MERGED)
def merge_upsert(spark, sf_dir):
    return m.merge(revisions(spark, sf_dir), table(spark, sf_dir, "orders"), KEYS, order_by=ORDER_BY)


@registry.query("merge_update_only", WITH_LAST + UPDATED)
def merge_update_only(spark, sf_dir):
    return m.update_rows(revisions(spark, sf_dir), table(spark, sf_dir, "orders"), KEYS, order_by=ORDER_BY)


@registry.query(
    "merge_update_subset",
    WITH_LAST.replace("o_totalprice DESC NULLS LAST, o_orderstatus DESC NULLS LAST", "o_totalprice DESC NULLS LAST")
    + UPDATED.replace(
        "CASE WHEN l.o_orderkey IS NOT NULL THEN l.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus",
        "o.o_orderstatus",
    ),
)
def merge_update_subset(spark, sf_dir):
    source, dest = revisions(spark, sf_dir), table(spark, sf_dir, "orders")
    return m.update_rows(source, dest, KEYS, update_columns=["o_totalprice"], order_by=ORDER_BY)


@registry.query(
    "merge_insert_only",
    f"{WITH_LAST} SELECT s.o_orderkey, s.o_totalprice, s.o_orderstatus, s.tag FROM src s WHERE {NEW}",
)
def merge_insert_only(spark, sf_dir):
    return m.insert_rows(revisions(spark, sf_dir), table(spark, sf_dir, "orders"), KEYS, order_by=ORDER_BY)


@registry.query("merge_counts", COUNTS)
def merge_counts(spark, sf_dir):
    return m.merge_counts(revisions(spark, sf_dir), table(spark, sf_dir, "orders"), KEYS)


_COMPOSITE = """
WITH src AS (SELECT l_partkey, l_suppkey, l_linenumber, max(l_extendedprice) AS l_extendedprice
             FROM lineitem GROUP BY l_partkey, l_suppkey, l_linenumber)
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, s.l_extendedprice, l.l_discount, l.l_tax,
       l.l_returnflag, l.l_linestatus, l.l_shipdate
FROM lineitem l JOIN src s ON l.l_partkey = s.l_partkey AND l.l_suppkey = s.l_suppkey AND l.l_linenumber = s.l_linenumber"""


@registry.query("merge_composite_key", _COMPOSITE)
def merge_composite_key(spark, sf_dir):
    """Several key columns, many destination rows per key, a source with unique keys and no ordering."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_partkey", "l_suppkey", "l_linenumber"]
    best = lines.groupBy(*keys).agg({"l_extendedprice": "max"}).withColumnRenamed(
        "max(l_extendedprice)", "l_extendedprice"
    )
    return m.merge(best, lines, keys)
