"""T1-T10, K8, K10, K11, A2, A3, U2."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from lodeworks.errors import DataError
from lodeworks.layout import parse_partition_cols
from lodeworks.operators import merge as m
from lodeworks.operators.tables import TableStore
from lodeworks.queries import merging
from lodeworks.queries.base import Registry, fresh_store, one_task_each, table

registry = Registry()

_ALL = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _orders_store(spark, sf_dir, partition_cols=("o_orderstatus",)):
    store = fresh_store(spark)
    store.append("orders", table(spark, sf_dir, "orders"), partition_cols)
    return store


@registry.query("append_twice", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_twice(spark, sf_dir):
    store, customer = fresh_store(spark), table(spark, sf_dir, "customer")
    store.append("customer", customer)
    store.append("customer", customer)
    return store.read("customer")


@registry.query(
    "append_evolve",
    """SELECT *, CAST(NULL AS BOOLEAN) AS overdrawn FROM orders
       UNION ALL SELECT o_orderkey, NULL, o_orderstatus, o_totalprice, o_orderdate, NULL, o_totalprice < 1000 FROM orders""",
)
def append_evolve(spark, sf_dir):
    """A later batch adds one column and lacks two, into a partitioned table."""
    store = _orders_store(spark, sf_dir)
    later = table(spark, sf_dir, "orders").drop("o_custkey", "o_orderpriority")
    store.append("orders", later.withColumn("overdrawn", F.col("o_totalprice") < 1000))
    return store.read("orders")


@registry.query(
    "table_overwrite",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders WHERE o_totalprice >= 100000""",
)
def table_overwrite(spark, sf_dir):
    """A table replaced by a query over itself."""
    store = _orders_store(spark, sf_dir)
    kept = store.read("orders", predicate="o_totalprice >= 100000")
    store.overwrite("orders", kept.withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return store.read("orders")


@registry.query("table_copy", "SELECT * FROM orders")
def table_copy(spark, sf_dir):
    store = _orders_store(spark, sf_dir)
    store.copy("orders", "orders_copy")
    return store.read("orders_copy")


def _merged_store(spark, sf_dir):
    store = _orders_store(spark, sf_dir)
    store.append("revisions", merging.revisions(spark, sf_dir))
    return store, store.merge("revisions", "orders", merging.KEYS, order_by=merging.ORDER_BY)


@registry.query("table_merge", merging.MERGED)
def table_merge(spark, sf_dir):
    """Stored upsert; the updates also move rows between partitions."""
    store, _ = _merged_store(spark, sf_dir)
    return store.read("orders")


@registry.query("table_merge_counts", merging.COUNTS)
def table_merge_counts(spark, sf_dir):
    _, result = _merged_store(spark, sf_dir)
    return spark.createDataFrame(
        [(result.rows_updated, result.updated, result.inserted)], "rows_updated long, updated long, inserted long"
    )


_LATEST = """
WITH src AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, 'new' AS tag, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
             UNION ALL SELECT o_orderkey + 10000000, o_totalprice, 'new', 'none' FROM orders WHERE o_orderstatus = 'P')
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, coalesce(s.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderdate,
       CAST(NULL AS VARCHAR) AS tag, o.o_orderpriority
FROM orders o LEFT JOIN src s ON s.o_orderkey = o.o_orderkey AND s.o_orderpriority = o.o_orderpriority
UNION ALL SELECT o_orderkey, NULL, NULL, o_totalprice, NULL, tag, o_orderpriority FROM src WHERE o_orderkey >= 10000000"""


@registry.query("table_merge_touched", _LATEST)
def table_merge_touched(spark, sf_dir):
    """Upsert that rewrites only the partitions it falls into, and adds one."""
    store = _orders_store(spark, sf_dir, ["o_orderpriority"])
    pending = store.read("orders", predicate="o_orderstatus = 'P'")
    changed = pending.selectExpr("o_orderkey", "o_totalprice + 1 AS o_totalprice", "'new' AS tag", "o_orderpriority")
    added = pending.selectExpr("o_orderkey + 10000000 AS o_orderkey", "o_totalprice", "'new' AS tag", "'none' AS o_orderpriority")
    store.append("latest", changed.unionByName(added))
    store.merge("latest", "orders", ["o_orderkey", "o_orderpriority"], touched_only=True)
    return store.read("orders")


@registry.query("merge_by_file", merging.MERGED)
def merge_by_file(spark, sf_dir):
    """Upsert into an unpartitioned table that rewrites only the files with matching keys."""
    store = fresh_store(spark)
    store.append("orders", table(spark, sf_dir, "orders").repartitionByRange(16, "o_orderkey"), cluster=False)
    store.append("revisions", merging.revisions(spark, sf_dir))
    store.merge("revisions", "orders", merging.KEYS, order_by=merging.ORDER_BY, by_file=True)
    return _elsewhere(store, spark).read("orders")


def _one_file_each(spark, sf_dir, parts):
    """Orders in a table with one file in each partition."""
    store = fresh_store(spark)
    orders = one_task_each(table(spark, sf_dir, "orders"), *parse_partition_cols(parts))
    store.append("orders", orders, parts, cluster=False)
    return store


@registry.query(
    "table_partitions",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS row_count, 1::BIGINT AS file_count FROM orders GROUP BY ALL",
)
def table_partitions(spark, sf_dir):
    return _one_file_each(spark, sf_dir, "o_orderstatus,o_orderpriority").partitions("orders")


@registry.query(
    "table_stats",
    """SELECT 'orders' AS table_name, count(*) AS row_count, 6 AS column_count,
              count(DISTINCT o_orderstatus) AS partition_count, count(DISTINCT o_orderstatus) AS file_count FROM orders""",
)
def table_stats(spark, sf_dir):
    stats = _one_file_each(spark, sf_dir, ["o_orderstatus"]).stats("orders")
    return stats.select("table_name", "row_count", "column_count", "partition_count", "file_count")


@registry.query(
    "table_schema",
    """SELECT * FROM (VALUES (1, 'o_orderkey', 'bigint', false), (2, 'o_custkey', 'bigint', false),
       (3, 'o_totalprice', 'double', false), (4, 'o_orderdate', 'timestamp_ntz', false),
       (5, 'o_orderpriority', 'string', false), (6, 'o_orderstatus', 'string', true)) t(position, name, type, is_partition)""",
)
def table_schema(spark, sf_dir):
    return _orders_store(spark, sf_dir).schema_rows("orders").drop("nullable")


@registry.query(
    "table_list", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL)
)
def table_list(spark, sf_dir):
    """Every given table stored; then what the listing names, with its rows."""
    store = fresh_store(spark)
    for name in _ALL:
        store.append(name, table(spark, sf_dir, name))
    counts = [
        store.read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in store.names()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


@registry.query("table_drop", "SELECT 'customer' AS table_name, count(*) AS row_count FROM customer")
def table_drop(spark, sf_dir):
    store = _orders_store(spark, sf_dir)
    store.append("customer", table(spark, sf_dir, "customer"))
    store.drop("orders")
    (left,) = store.names()
    return store.read(left).agg(F.lit(left).alias("table_name"), F.count(F.lit(1)).alias("row_count"))


@registry.query(
    "table_exists",
    """SELECT 'orders' AS table_name, true AS found, count(*) AS row_count FROM orders
       UNION ALL SELECT 'missing', false, 0""",
)
def table_exists(spark, sf_dir):
    store = _orders_store(spark, sf_dir)
    known = store.read("orders").agg(
        F.lit("orders").alias("table_name"),
        F.lit(store.exists("orders")).alias("found"),
        F.count(F.lit(1)).alias("row_count"),
    )
    unknown = spark.createDataFrame([("missing", store.exists("missing"), 0)], known.schema)
    return known.unionByName(unknown)


def losing_commits(folders):
    """Let the next commit fail, as where a driver is lost between a write and its version."""
    real = folders.write_text

    def lost(path, text):
        folders.write_text = real
        raise ConnectionError(path)

    folders.write_text = lost


@registry.query("append_lost_commit", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_lost_commit(spark, sf_dir):
    """An append that fails between its write and its commit, twice, and then succeeds: its rows once."""
    store = _orders_store(spark, sf_dir)
    for _ in range(2):
        losing_commits(store.folders)
        try:
            store.append("orders", table(spark, sf_dir, "orders"))
        except ConnectionError:
            continue
        raise AssertionError("the commit was not lost")
    store.append("orders", table(spark, sf_dir, "orders"))
    return _elsewhere(store, spark).read("orders")


@registry.query("append_run_twice", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_run_twice(spark, sf_dir):
    """Of two appends with one run id, by two sessions, the second adds nothing."""
    store = _orders_store(spark, sf_dir)
    store.append("orders", table(spark, sf_dir, "orders"), run_id="nightly")
    _elsewhere(store, spark).append("orders", table(spark, sf_dir, "orders"), run_id="nightly")
    return store.read("orders")


@registry.query(
    "table_compact",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(true AS BOOLEAN) AS fewer
       FROM orders UNION ALL SELECT *, true FROM orders UNION ALL SELECT *, true FROM orders""",
)
def table_compact(spark, sf_dir):
    """Appends folded into one layer, then all layers into one: fewer files each time, the same rows."""
    store, files = _orders_store(spark, sf_dir), []
    for _ in range(2):
        store.append("orders", table(spark, sf_dir, "orders").repartition(4), cluster=False)
    for whole in (None, False, True):
        if whole is not None:
            store.compact("orders", whole)
        files.append(store.stats("orders").first()["file_count"])
    return store.read("orders").withColumn("fewer", F.lit(files[0] > files[1] > files[2]))


@registry.query(
    "table_skip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true AS skipped FROM orders
       WHERE o_totalprice BETWEEN 100000 AND 110000
       UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true FROM orders
       WHERE o_totalprice BETWEEN 100000 AND 110000 AND o_orderkey % 2 = 0""",
)
def table_skip(spark, sf_dir):
    """A range of prices out of a table laid out and indexed by price, and of an append that isn't indexed."""
    store, orders = fresh_store(spark), table(spark, sf_dir, "orders")
    cheap_first = orders.repartitionByRange(8, "o_totalprice")
    store.append("orders", cheap_first, cluster=False)
    store.index("orders", ["o_totalprice", "o_orderdate"])
    wanted = {"o_totalprice": (100000, 110000)}
    few = store.read("orders", between=wanted).select(F.input_file_name().alias("f")).distinct().count()
    store.append("orders", orders.filter("o_orderkey % 2 = 0"))
    skipped = few < store.stats("orders").first()["file_count"]
    return store.read("orders", between=wanted).withColumn("skipped", F.lit(skipped))


@registry.query("table_merge_conflict", merging.MERGED)
def table_merge_conflict(spark, sf_dir):
    """Of two merges that meet the later is refused: the table has all of the earlier one and nothing else."""
    store = _orders_store(spark, sf_dir)
    store.append("revisions", merging.revisions(spark, sf_dir))
    other, write = _elsewhere(store, spark), store._write

    def meanwhile(df, parts, path):
        store._write = write
        other.merge("revisions", "orders", merging.KEYS, order_by=merging.ORDER_BY)
        return write(df, parts, path)

    store._write = meanwhile
    try:
        store.merge("revisions", "orders", merging.KEYS, order_by=merging.ORDER_BY)
    except DataError:
        return store.read("orders")
    raise AssertionError("the later merge was not refused")


@registry.query(
    "table_create",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 0 AS rows_before FROM orders""",
)
def table_create(spark, sf_dir):
    """An empty partitioned table is readable, and then takes rows."""
    store, orders = fresh_store(spark), table(spark, sf_dir, "orders")
    store.create("orders", orders.schema, ["o_orderpriority"])
    before = store.read("orders").count()
    store.append("orders", orders)
    return store.read("orders").withColumn("rows_before", F.lit(before))


def _elsewhere(store, spark):
    """The same layout through a catalog that has seen none of it."""
    return TableStore(spark, replace(store.layout, database=f"{store.layout.database}_{uuid.uuid4().hex[:6]}"))


@registry.query("table_attach", "SELECT * FROM orders")
def table_attach(spark, sf_dir):
    """Another catalog picks the table up."""
    other = _elsewhere(_orders_store(spark, sf_dir), spark)
    other.attach("orders")
    return other.read("orders")


@registry.query("append_new_catalog", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_new_catalog(spark, sf_dir):
    """Two sessions append, a third reads."""
    store = _orders_store(spark, sf_dir)
    _elsewhere(store, spark).append("orders", table(spark, sf_dir, "orders"))
    return _elsewhere(store, spark).read("orders")


@registry.query(
    "attach_evolved",
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS extra, lpad(CAST(o_orderkey % 7 AS VARCHAR), 3, '0') AS code FROM orders
       UNION ALL SELECT o_orderkey, NULL, o_totalprice, lpad(CAST(o_orderkey % 7 AS VARCHAR), 3, '0') FROM orders""",
)
def attach_evolved(spark, sf_dir):
    """A column added later and partition values like 001 are the same in another catalog."""
    orders, store = table(spark, sf_dir, "orders"), fresh_store(spark)
    coded = orders.withColumn("code", F.lpad((F.col("o_orderkey") % 7).cast("string"), 3, "0"))
    store.append("orders", coded.select("o_orderkey", "o_totalprice", "code"), "code")
    store.append("orders", coded.select("o_orderkey", F.col("o_totalprice").alias("extra"), "code"))
    other = _elsewhere(store, spark)
    return other.read(other.names()[0])


@registry.query("append_mixed_case", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def append_mixed_case(spark, sf_dir):
    store, customer = fresh_store(spark), table(spark, sf_dir, "customer")
    store.append("customer", customer, "C_MktSegment")
    store.append("customer", customer.select(*reversed(customer.columns)).toDF(*[c.upper() for c in reversed(customer.columns)]))
    return store.read("customer")


@registry.query("merge_mixed_case", merging.MERGED)
def merge_mixed_case(spark, sf_dir):
    """Columns of the source in capitals."""
    changes = merging.revisions(spark, sf_dir)
    merged = m.merge(
        changes.toDF(*[c.upper() if c != "tag" else c for c in changes.columns]), table(spark, sf_dir, "orders"),
        [k.title() for k in merging.KEYS], order_by=merging.ORDER_BY,
    )
    return merged
