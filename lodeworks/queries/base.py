"""Registration of queries and the frames several of them share."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.functions.columns import all_of, named
from lodeworks.layout import LakeLayout
from lodeworks.operators.tables import TableStore
from lodeworks.storage import work_folder

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2024-06-01 00:00:00"


class Registry:
    """The queries of one module, by name, each with its SQL or None."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, run: Query, sql: str | None = None) -> None:
        self.queries[name] = run
        if sql is not None:
            self.sql[name] = sql

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(run: Query) -> Query:
            self.add(name, run, sql)
            return run

        return register


def queries_of(modules: Iterable[ModuleType]) -> dict[str, Query]:
    return {name: run for m in modules for name, run in m.registry.queries.items()}


def oracle_of(modules: Iterable[ModuleType]) -> dict[str, str]:
    return {name: sql for m in modules for name, sql in m.registry.sql.items()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_layout(spark: SparkSession) -> LakeLayout:
    """A layout in a new shared folder with a database of its own, so runs never meet."""
    root = work_folder(spark, "lake")
    return LakeLayout.under(root, database="lake_" + root.rsplit("-", 1)[1])


def fresh_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, fresh_layout(spark))


def one_task_each(df: DataFrame, *parts: str) -> DataFrame:
    """The rows of each value of ``parts`` in a task of their own, so that a write makes one file per folder.

    A value's rows are all that a task reads and sorts; a single task for all would grow with the whole table.
    """
    folders = df.select(*[named(p).alias(f"__{p}") for p in parts]).distinct()
    folders = folders.withColumn("__task", F.row_number().over(Window.orderBy(*[named(c) for c in folders.columns])) - 1)
    dealt = df.join(F.broadcast(folders), all_of([named(p).eqNullSafe(named(f"__{p}")) for p in parts]))
    return dealt.repartitionById(max(1, folders.count()), F.col("__task")).select(*[named(c) for c in df.columns])


# The given tables hold no NULL, so quality queries blank some cells by fixed rules. Every row stays.
DIRTY_SQL = """
SELECT event_id, ts,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
       props
FROM events"""

DIRTY_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")

ISSUES_SQL = (
    "nullif(concat_ws(', ', "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN 'Null value in {c}' END" for c in DIRTY_COLUMNS)
    + "), '')"
)


def blank_some(events: DataFrame) -> DataFrame:
    """The transform that makes `DIRTY_SQL` out of ``events``; other columns pass through."""

    def blank(column: str, every: int):
        return F.when(F.col("event_id") % every == 0, None).otherwise(F.col(column))

    return events.withColumns(
        {"user_id": blank("user_id", 11), "event_type": blank("event_type", 5), "value": blank("value", 7)}
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blank_some(table(spark, sf_dir, "events"))


def naive(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as wall-clock values, the type the SQL side has."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
