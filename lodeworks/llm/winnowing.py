"""Document fingerprints by winnowing, in Spark's own expressions.

A text's words are hashed, every ``GRAM`` neighbouring word hashes are hashed again, and of each window of
``WINDOW`` such hashes the smallest is chosen, of equal ones the rightmost. The chosen (hash, place) pairs
are the fingerprint. So any passage of GRAM + WINDOW - 1 words that two texts share has a chosen hash in
common, and its place is known in both. A text with fewer words than that, or with over ``LONG`` characters
to a word, as where words aren't set apart, goes by its characters instead, blanks left out, with the same
guarantee for characters. One with fewer characters than a gram has one gram; one with fewer grams than a window
has one window.

Hash and place are one number, hash * 2^32 + (2^32 - 1 - place), whose minimum is what a window chooses.
The minimum of a window is the least of two half windows, so it takes log2(WINDOW) passes over an array.

Edge cases: a null text counts as empty; a text without words has an empty fingerprint, and two empty
fingerprints are alike with 1; equal texts have equal fingerprints; very long texts are taken whole and
stay in their own row; rows that repeat an id are ordered by a hash of their text; a null id comes after
all others; of a single document, the next is itself; an empty table gives an empty result. Only id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.frames import documents, text_of, written

GRAM, WINDOW = 5, 8
#: Characters to a word, blanks included, beyond which words are no units.
LONG = 24
#: Ranges of ids at most.
RANGES = 1 << 16
_PLACES = 2**32 - 1


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The fingerprint of a text: chosen hashes with their places, by place."""

    def units(words: Column) -> Column:
        plain = (F.size(words) >= gram + window - 1) & (F.char_length(text) <= LONG * F.size(words))
        return F.when(plain | (F.size(words) == 0), words).otherwise(
            F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]"), F.lit(0))
        )

    words = _let(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), units)

    def grams(hashes: Column) -> Column:
        def one(i: Column) -> Column:
            mixed = F.xxhash64(*[F.get(hashes, i + j) for j in range(gram)])
            return F.shiftleft(mixed.bitwiseAND(F.lit(2**31 - 1)), 32).bitwiseOR(F.lit(_PLACES) - i.cast("long"))

        last = F.greatest(F.lit(0), F.size(hashes) - gram)
        return F.when(F.size(hashes) > 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(
            F.array().cast("array<bigint>")
        )

    def wider(step: int) -> Callable[[Column], Column]:
        return lambda least: F.transform(least, lambda x, i: F.least(x, F.get(least, i + step)))

    def chosen(least: Column) -> Column:
        full = F.slice(least, 1, F.greatest(F.lit(1), F.size(least) - window + 1))
        return _let(full, lambda a: F.filter(a, lambda x, i: (i == 0) | (x != F.get(a, i - 1))))

    out = _let(F.transform(words, lambda w: F.xxhash64(w)), grams)
    step = 1
    while 2 * step <= window:
        out, step = _let(out, wider(step)), 2 * step
    if step < window:  # two half windows that overlap
        out = _let(out, wider(window - step))
    return _let(out, chosen)


def written_out(found: Column) -> Column:
    """A fingerprint as text: hash:place, hash in hexadecimal, place counted from 0."""
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(
                ":", F.hex(F.shiftright(x, 32)), (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).cast("string")
            ),
        ),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes of two fingerprints over all their hashes, 0 to 1."""

    def hashes(found: Column) -> Column:
        return F.array_distinct(F.transform(found, lambda x: F.shiftright(x, 32)))

    def ratio(both: Column) -> Column:
        shared = F.size(F.array_intersect(both[0], both[1]))
        total = F.size(both[0]) + F.size(both[1]) - shared
        return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)

    return _let(F.array(hashes(a), hashes(b)), ratio)


def _borders(keyed: DataFrame) -> list[int]:
    """Ids at which ranges of about sqrt(rows) rows begin."""
    many = keyed.count()
    cuts = min(RANGES, math.isqrt(many))
    if cuts < 2:
        return []
    shares = [i / cuts for i in range(1, cuts)]
    found = keyed.agg(F.percentile_approx("id", shares, 10 * cuts)).first()[0] or []
    return sorted(set(found))


def _range(row_id: Column, borders: list[int]) -> Column:
    """How many borders an id has reached, by halving; ids without a value make a range below all."""
    steps = [1 << i for i in reversed(range(len(borders).bit_length()))]
    if not borders:
        return F.when(row_id.isNull(), -1).otherwise(0)
    known = F.array(*[F.lit(b).cast("long") for b in borders]) if len(borders) < 100 else F.from_json(F.lit(str(borders)), "array<bigint>")

    def found(at: Column) -> Column:
        def on(place: Column, step: Column) -> Column:
            return F.when(F.get(at, place + step - 1) <= row_id, place + step).otherwise(place)

        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), on)

    return F.when(row_id.isNull(), -1).otherwise(_let(known, found))


def with_next(docs: DataFrame) -> DataFrame:
    """(id, body, found, next_body, next_found): each document and the next by descending id, in a circle.

    Ids are cut into about sqrt(rows) ranges of about as many rows each, at quantiles of the ids, however these
    are spread. Inside a range a window finds the next document; the last of a range is followed by the first
    of the range below, a row per range, which is joined to it.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("body"))
    keyed = keyed.withColumn("tie", F.xxhash64("body"))
    keyed = keyed.withColumn("range", _range(F.col("id"), _borders(keyed)))
    full = keyed.withColumn("found", winnow(F.col("body")))
    # A row per range: at most sqrt(rows) + 2.
    order = Window.orderBy("range")
    firsts = keyed.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("first"))
    firsts = firsts.select(
        F.col("first.id").alias("first_id"), F.col("first.tie").alias("first_tie"),
        F.coalesce(F.lead("range").over(order), F.min("range").over(Window.partitionBy())).alias("above"),
    )
    heads = keyed.join(
        F.broadcast(written(firsts, "firsts")),
        F.col("id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie")),
    )
    heads = heads.groupBy("above").agg(F.first("body").alias("head_body"))
    heads = heads.withColumn("head_found", winnow(F.col("head_body")))
    down = Window.partitionBy("range").orderBy(F.col("id").desc_nulls_last(), F.col("tie").desc())
    rows = full.select(
        "id", "range", "body", "found", F.lead("body").over(down).alias("after_body"),
        F.lead("found").over(down).alias("after_found"),
    )
    rows = rows.join(
        written(heads, "heads"), (F.col("range") == F.col("above")) & F.col("after_body").isNull(), "left"
    )
    return rows.select(
        "id", "body", "found", F.coalesce("after_body", "head_body").alias("next_body"),
        F.coalesce("after_found", "head_found").alias("next_found"),
    )


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, fingerprinted as they are and with their last third replaced."""
    rows = with_next(documents(spark, sf_dir)).withColumn("n_chars", F.char_length("body").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("body", F.col("n_chars").cast("int") - third), F.left("next_body", third))
    rows = rows.withColumn("edited", edited).withColumn("edited_found", winnow(F.col("edited")))
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written_out(F.col("found")).alias("fingerprint"),
        written_out(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    )
