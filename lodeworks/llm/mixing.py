"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight, which sets how many words it gives, and a schedule, which sets when: its
weight runs linearly from ``start`` to ``end`` times its mean over the training time 0..1. The integral
of the schedule is the source's cumulative demand; inverting it at a document's place in the source's
own shuffled order gives the document's training position, and the documents are range-sorted by it.
A source with a target above its size is passed through several times, the last pass as far as needed.

The running total inside a source is found in two levels: about sqrt(rows) buckets of the shuffled order,
and rows inside a bucket. So neither level puts a hot source into one task.

Edge cases: a null text has size 0 and is never taken; null sources are one source, the last; a source
without words has target 0; ties and repeated rows are ordered by id, then size; an empty table gives an
empty result; the input's own columns are carried along by `plan` under their names, the working columns
have names that start with ``__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.frames import WORD, boxed, documents, unboxed, written

#: Weights by the rank of the source's name, repeating.
WEIGHTS = (5, 2, 1)
#: (start, end) of the schedules, by the same rank, repeating: a source that fades, a level one, a growing one.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: No target exceeds so many times its source's size.
MOST = 3


def _pick(values, rank):
    out = F.lit(values[-1])
    for i, v in list(enumerate(values))[-2::-1]:
        out = F.when(rank % len(values) == i, F.lit(v)).otherwise(out)
    return out


def targets(sizes: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, most: int = MOST) -> DataFrame:
    """From (source, source_size): weight, schedule, target and words to take, one row per source.

    Targets share the total by weight; those above ``most`` times their size stop there and the excess is
    shared again. With sources by rising size per weight, the capped ones come first, and what is left per
    unit of weight before a source says whether it is capped; past the first open one it only falls, so the
    largest among the open ones is the level. The rows are sources, not documents.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.select(
        "source", "source_size", _pick(weights, F.col("rank")).cast("long").alias("weight"),
        _pick([a for a, _ in schedules], F.col("rank")).alias("start"),
        _pick([b for _, b in schedules], F.col("rank")).alias("end"), "rank",
    ).withColumn("cap", F.col("source_size") * most)
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_room), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0))
    levelled = ranked.withColumn("level", left / open_weight)
    levelled = levelled.withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    levelled = levelled.withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
    target = F.when(F.col("open"), F.col("level") * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return levelled.select(
        "source", "source_size", "start", "end", target.alias("target"), F.floor(target + 0.5).alias("words"),
    )


def _cell(source, bucket):
    """Source and bucket as one value; no source is unlike the source that is empty."""
    return F.concat(bucket.cast("string"), F.coalesce(F.concat(F.lit(":"), source), F.lit("")))


def position(share, start, end):
    """The time in 0..1 at which a source with this schedule has given ``share`` of its words.

    The mean weight is (start + end) / 2 and the integral start*t + (end-start)*t*t/2; this is its inverse
    in the form that needs no division by end - start.
    """
    area = share * (start + end)
    return area / (start + F.sqrt(start * start + (end - start) * area))


def plan(docs: DataFrame) -> DataFrame:
    """``docs`` with __size, __source_size, __target, __taken and __turns: (words, position) of each pass.

    One shuffle carries the rows, by source and bucket. All passes over a document are in __turns, at most
    ``MOST``; a document that isn't taken has none.
    """
    # The order of a source is the order of md5(id): any prefix of it is a bucket.
    sized = docs.withColumns({
        "__size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "__order": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
    })
    slim = written(sized.select("source", "__size", "__order"), "sizes")
    many = max(1, int(slim.count() ** 0.5))
    bucket = F.floor(F.conv(F.substring("__order", 1, 8), 16, 10).cast("long") * many / 2**32)
    sums = slim.groupBy("source", bucket.alias("__bucket")).agg(F.sum("__size").alias("__words"))
    before = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = written(sums.withColumn("__before", F.coalesce(F.sum("__words").over(before), F.lit(0))), "buckets")
    shares = targets(sums.groupBy("source").agg(F.sum("__words").alias("source_size")))
    offsets = sums.alias("s").join(shares.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        _cell(F.col("s.source"), F.col("s.__bucket")).alias("__cell"), "__before",
        F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
        F.col("words").alias("__quota"), F.col("start").alias("__start"), F.col("end").alias("__end"),
    )
    # One key column, so that the window needs no shuffle beyond the join's.
    rows = sized.withColumn("__cell", _cell(F.col("source"), bucket)).join(written(offsets, "offsets"), "__cell")
    inside = (
        Window.partitionBy("__cell").orderBy("__order", "doc_id", "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("__at", F.col("__before") + F.coalesce(F.sum("__size").over(inside), F.lit(0)))

    def turn(k):
        begin = k * F.col("__source_size") + F.col("__at")
        words = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__quota") - begin))
        share = F.least(F.lit(1.0), (begin + words / 2) / F.col("__quota"))
        return F.struct(words.alias("words"), position(share, F.col("__start"), F.col("__end")).alias("position"))

    turns = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(MOST - 1)), lambda k: F.when(F.col("__quota") > 0, turn(k))),
        lambda t: t["words"] > 0,
    )
    rows = rows.withColumn("__turns", turns)
    taken = F.aggregate("__turns", F.lit(0).cast("long"), lambda total, t: total + t["words"])
    return rows.withColumn("__taken", taken).drop(
        "__order", "__cell", "__before", "__at", "__quota", "__start", "__end"
    )


def training_order(docs: DataFrame) -> DataFrame:
    """``docs`` as they are trained on: a row per pass that takes at least half of the document, range-sorted.

    Texts stay whole; the one document of a source at which its target is reached is in if the larger part
    of it is. Columns are those of ``docs``.
    """
    planned = plan(docs.select("doc_id", "source", "text", boxed(docs)))
    turns = planned.select("row", "doc_id", "__size", F.explode("__turns").alias("turn")).filter("2 * turn.words >= __size")
    return unboxed(turns.orderBy(F.col("turn.position"), "doc_id"), docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents` with what the mix takes of each, range-sorted by first training position."""
    planned = plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return planned.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__taken").alias("taken"),
        F.size("__turns").alias("passes"), F.get("__turns", F.lit(0))["position"].alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


OP5_SQL = """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank,
         CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         CASE rank % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS a,
         CASE rank % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS b
  FROM s),
v AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0) AS DOUBLE)
            / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS DOUBLE) AS lev
  FROM r WINDOW p AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, a, b,
         CASE WHEN lev * weight < cap THEN (max(lev) FILTER (lev * weight < cap) OVER ()) * weight
              ELSE CAST(cap AS DOUBLE) END AS target, CAST(floor(target + 0.5) AS BIGINT) AS quota
  FROM v),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.quota, t.a, t.b,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
w AS (
  SELECT *, greatest(0, least(size, quota - pos)) AS w0,
         greatest(0, least(size, quota - pos - source_size)) AS w1,
         greatest(0, least(size, quota - pos - 2 * source_size)) AS w2
  FROM c)
SELECT doc_id, size, source_size, target, CAST(w0 + w1 + w2 AS BIGINT) AS taken,
       CAST(CAST(w0 > 0 AS INT) + CAST(w1 > 0 AS INT) + CAST(w2 > 0 AS INT) AS INTEGER) AS passes,
       CASE WHEN w0 > 0 THEN (least(1.0, (pos + w0 / 2) / quota) * (a + b))
            / (a + sqrt(a * a + (b - a) * (least(1.0, (pos + w0 / 2) / quota) * (a + b)))) END AS position
FROM w"""
