"""P1-P3."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.functions.lineage import normalise_ingest_timestamp, stamp_bronze, stamp_silver
from lodeworks.queries.base import RUN_TS, Registry, fresh_layout, naive, table
from lodeworks.sinks.writers import write_dataset
from lodeworks.sources.readers import read_source

registry = Registry()

BRONZE_SQL = f"""TIMESTAMP '{RUN_TS}' AS bronze_ingest_timestamp, '2024-06-01' AS bronze_ingest_date,
       '00-00-00' AS bronze_ingest_time"""
SILVER_SQL = f"""TIMESTAMP '{RUN_TS}' AS silver_process_timestamp, '2024-06-01' AS silver_process_date,
       '00-00-00' AS silver_process_time"""


@registry.query("bronze_stamp", f"SELECT *, {BRONZE_SQL}, 'landing/customer' AS bronze_source_path FROM customer")
def bronze_stamp(spark, sf_dir):
    stamped = stamp_bronze(table(spark, sf_dir, "customer"), "landing/customer", RUN_TS)
    return naive(stamped, "bronze_ingest_timestamp")


@registry.query(
    "silver_stamp",
    f"""SELECT *, {BRONZE_SQL}, 'landing/customer' AS bronze_source_path,
        {SILVER_SQL}, 'bronze/customer' AS silver_source_path FROM customer""",
)
def silver_stamp(spark, sf_dir):
    """The ingest time has been through JSON, which brings it back as text."""
    customer = table(spark, sf_dir, "customer")
    path = fresh_layout(spark).bronze_path("customer")
    write_dataset(stamp_bronze(customer, "landing/customer", RUN_TS), path, "json")
    bronze = read_source(spark, "json", path).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))
    return naive(
        stamp_silver(bronze, "bronze/customer", RUN_TS), "bronze_ingest_timestamp", "silver_process_timestamp"
    )


@registry.query(
    "normalise_timestamp",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS bronze_ingest_timestamp FROM events""",
)
def normalise_timestamp(spark, sf_dir):
    """Text that is no timestamp becomes NULL instead of failing the query."""
    noisy = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "not a time")
        .otherwise(F.col("ts").cast("string"))
        .alias("bronze_ingest_timestamp"),
    )
    return naive(normalise_ingest_timestamp(noisy), "bronze_ingest_timestamp")
