"""S1-S4 with K1-K7: tables written in a format and read back.

JDBC (S5) has no query here: the only database in reach would be one that lives inside this
process, which executors elsewhere cannot see.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.queries.base import Registry, fresh_layout, table
from lodeworks.sinks import writers
from lodeworks.sources.readers import read_source

registry = Registry()


def _round_trip(fmt: str, name: str):
    def run(spark, sf_dir):
        df = table(spark, sf_dir, name)
        path = fresh_layout(spark).bronze_path(name)
        writers.write_dataset(df, path, fmt)
        return read_source(spark, fmt, path, schema=df.schema)

    return run


for _fmt in ("csv", "json", "parquet", "orc"):
    registry.add(f"{_fmt}_roundtrip", _round_trip(_fmt, "events"), "SELECT * FROM events")
    registry.add(f"{_fmt}_roundtrip_customer", _round_trip(_fmt, "customer"), "SELECT * FROM customer")

# Free text holds quotes, line breaks and edge blanks.
for _name in ("documents", "pages", "conversations"):
    registry.add(f"csv_roundtrip_{_name}", _round_trip("csv", _name), f"SELECT * FROM {_name}")
    registry.add(f"json_roundtrip_{_name}", _round_trip("json", _name), f"SELECT * FROM {_name}")


def _nested(fmt: str):
    run = _round_trip(fmt, "embeddings")

    def flat(spark, sf_dir):
        return run(spark, sf_dir).select("vec_id", "label", F.posexplode("embedding").alias("pos", "x"))

    return flat


for _fmt in ("json", "parquet", "orc"):
    registry.add(
        f"{_fmt}_roundtrip_embeddings",
        _nested(_fmt),
        """SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS pos, embedding[i] AS x
           FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    )


@registry.query(
    "csv_inferred", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
)
def csv_inferred(spark, sf_dir):
    """Header and types found by the reader: small whole numbers come back as int."""
    path = fresh_layout(spark).bronze_path("customer")
    writers.write_dataset(table(spark, sf_dir, "customer"), path, "csv")
    return read_source(spark, "csv", path)


@registry.query(
    "json_inferred", "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer"
)
def json_inferred(spark, sf_dir):
    path = fresh_layout(spark).bronze_path("customer")
    writers.write_dataset(table(spark, sf_dir, "customer"), path, "json")
    return read_source(spark, "json", path)


@registry.query("partitioned_write", "SELECT * FROM orders")
def partitioned_write(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = fresh_layout(spark).bronze_path("orders")
    writers.write_dataset(orders, path, "parquet", "o_orderstatus,o_orderpriority")
    return read_source(spark, "parquet", path).select(*orders.columns)


@registry.query(
    "partitioned_write_null",
    """SELECT o_orderkey, o_totalprice, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders""",
)
def partitioned_write_null(spark, sf_dir):
    """A NULL partition value reads back as NULL."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "nullif(o_orderstatus, 'P') AS o_orderstatus"
    )
    path = fresh_layout(spark).bronze_path("orders")
    writers.write_dataset(orders, path, "orc", ["o_orderstatus"])
    return read_source(spark, "orc", path)


@registry.query("append_files", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_files(spark, sf_dir):
    """Bronze only appends, so a rerun duplicates."""
    customer = table(spark, sf_dir, "customer")
    path = fresh_layout(spark).bronze_path("customer")
    for _ in range(2):
        writers.write_dataset(customer, path, "json")
    return read_source(spark, "json", path, schema=customer.schema)
