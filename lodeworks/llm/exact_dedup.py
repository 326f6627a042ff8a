"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest, one row per text ever accepted. A delivery is cut to
one row per digest by an aggregation with map-side combine, sort-merge anti-joined with the index (whose
side needs no shuffle), and what is left is appended. Running a delivery again adds nothing, so a driver
lost between two steps only has to repeat it.

Edge cases: a null text counts as empty; a null id never wins over a given one; rows that repeat both id
and text are all marked alike by ``decide`` and cut to one by ``keep``; an empty delivery adds nothing.
Columns of the input other than id and text are free to have any name: only those two are read, under
names of this module's own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.frames import boxed, documents, text_of, unboxed, written
from lodeworks.storage import Folders, work_folder


def digest_of(column: str = "text") -> Column:
    return F.sha2(text_of(column).cast("binary"), 256)


class DigestIndex:
    """Digests of accepted texts with the id that stands for each, at ``path``.

    An index found at ``path`` is opened with the number of buckets it was made with; a new one gets
    ``buckets``, by default as many as the session has shuffle partitions, so that writing needs one file
    per bucket and delivery.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self._spark = spark
        self._table = f"digest_index_{uuid.uuid4().hex}"
        self._rows, facts = f"{path}/rows", f"{path}/facts"
        if Folders(spark).exists(f"{facts}/_SUCCESS"):
            buckets = spark.read.parquet(facts).first()["buckets"]
        else:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(buckets).cast("int").alias("buckets")).write.mode("overwrite").parquet(facts)
        self.buckets = buckets
        spark.sql(
            f"CREATE TABLE {self._table} (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self._rows}'"
        )

    def rows(self) -> DataFrame:
        """(digest, keep_id), one row per accepted text."""
        self._spark.catalog.refreshTable(self._table)
        return self._spark.table(self._table)

    def absorb(self, stamped: DataFrame) -> None:
        """Append what is new in a delivery of (id, digest); of equal texts the largest id stays."""
        # Written, as the optimizer would otherwise move the join below the aggregation, and a digest that many
        # rows share would be shuffled row by row.
        newest = written(stamped.groupBy("digest").agg(F.max("id").alias("keep_id")), "newest")
        fresh = newest.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        # Written aside first: a table can't be appended to while it is read.
        fresh = written(fresh.select("digest", F.col("keep_id").cast("long")), "digests")
        (
            fresh.repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self._rows).format("parquet").mode("append").saveAsTable(self._table)
        )

    def forget(self) -> None:
        """Drop the session's name for the index; its files stay."""
        self._spark.sql(f"DROP TABLE IF EXISTS {self._table}")


def stamp(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), digest_of(text_column).alias("digest"))


def decide(stamped: DataFrame, index: DigestIndex) -> DataFrame:
    """Every row of (id, digest) with keep_id, group_size and kept.

    The joined side holds one row per digest and both sides come from files, so that adaptive execution
    can split the partition of a digest that a third of the rows share.
    """
    sizes = stamped.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = written(sizes.join(index.rows(), "digest"), "groups")
    return stamped.join(groups, "digest").select(
        "id", "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def keep(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; index must have absorbed them.

    Rows are matched by id and digest, so a text that a third of the rows share is no hot key.
    """

    def key(digest: Column, row_id: str) -> Column:
        return F.concat(digest, F.lit(":"), F.coalesce(F.col(row_id).cast("long").cast("string"), F.lit("")))

    # One key column, so that the window needs no shuffle beyond the join's.
    accepted = index.rows().select(key(F.col("digest"), "keep_id").alias("at"))
    kept = docs.select(boxed(docs), key(digest_of(), "doc_id").alias("at")).join(accepted, "at", "left_semi")
    once = Window.partitionBy("at").orderBy(F.lit(0))
    return unboxed(kept.withColumn("copy", F.row_number().over(once)).filter("copy = 1"), docs.columns)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, delivered in two parts: the upper half of the ids, then the lower.

    The second part meets the index that the first has left, and since larger ids come first, the text
    that stays is the one with the largest id.
    """
    stamped = written(stamp(documents(spark, sf_dir)), "stamped")
    low, high = stamped.agg(F.min("id"), F.max("id")).first()
    middle = ((low or 0) + (high or 0)) // 2  # ids may span the whole range of long
    index = DigestIndex(spark, work_folder(spark, "digest-index"))
    upper = F.coalesce(F.col("id") > middle, F.lit(False))
    index.absorb(stamped.filter(upper))
    index.absorb(stamped.filter(~upper))
    return decide(stamped, index).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""
