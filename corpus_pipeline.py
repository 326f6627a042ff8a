"""From `documents` to token ids: toxicity, exact dedup, near-dedup, mixing, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last
return the columns of `documents`; rows of the mix come as often as they are trained on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeworks.llm import bpe, exact_dedup, mixing, near_simhash, toxicity
from lodeworks.llm.frames import documents
from lodeworks.storage import work_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5, by a model of the labels outside the held-out fold."""
    return toxicity.keep(docs, toxicity.learn(docs, toxicity.training_labels(spark, sf_dir)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id, by way of a new digest index."""
    index = exact_dedup.DigestIndex(spark, work_folder(spark, "digest-index"))
    index.absorb(exact_dedup.stamp(docs))
    return exact_dedup.keep(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts that share 0.8 or more of their 5-word shingles the row with the smallest doc_id.

    SimHash fingerprints within a radius wide enough for that similarity, tile by tile, name the pairs; texts of these are
    compared exactly. Shingle and radius are the stage's own, not those of ``simhash`` and its query.
    """
    return near_simhash.keep(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in training order, a row as often as the mix takes it."""
    return mixing.training_order(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, and of what they decode to, of every row."""
    return bpe.digests(docs, *bpe.vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_level_bpe", to_token_ids),
]

#: SQL can't express the trained model, the fingerprints or the merges; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written, and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = work_folder(spark, name.replace("_", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
