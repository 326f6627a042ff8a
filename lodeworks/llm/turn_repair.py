"""Repair of conversations whose turns are lost, blank, repeated, cut off or under a wrong role.

A conversation's rows become a sequence of the initials of their roles, and the cheapest edits are sought that
give ``(s?(ua)+)?``: a system turn at most, then pairs of user and assistant. Every row is kept, given another
role or deleted, and rows with empty texts are inserted; ``COST`` has the prices.

The cheapest edits are the lightest path through a directed acyclic graph: its nodes are (row, state of the
grammar), its edges are edits. The weight of a path is one big integer. The high digits are the cost; below lie
digits of fixed width and place, one for each edit in order, which spell the letters of the audit, and zeros
after the last. So an ordinary minimum of integers takes the cheapest path and, of equally cheap ones, that
whose audit comes first in ASCII. Of the edits that leave a node no two have the same letter, as the grammar
leaves one role for each; so digits of later rows can never decide, and the integers of a long conversation are
begun anew every `SEGMENT` rows with the costs alone.

Spark finds the faults: rows that repeat role and text by a window over digests, so that no task holds a
conversation's texts for it. Small rows without texts, a conversation's in order, give the audits. Then texts are
sorted beside their audits and hashed as a stream; a task holds one row and one audit at a time.

A conversation's digest runs over its texts in order, so that one task has to pass over them all, however
many there are; it does so as a stream from Spark's sort, which spills.

Edge cases: null text, role, and null parts of the name that damage goes by count as one space, so a null text is
blank and a null role has an initial that no grammar knows, as has an empty role; a null conv_id is a conversation
like any other; null turns come first and have no part in gaps; rows of one turn are ordered by role, then by
the digest of their text as given, nulls as the space; repeated rows are repeated turns; an empty table gives an
empty result; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.frames import map_batches, written

#: Prices of the edits, and what a truncated row that stays costs besides.
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
#: Kinds of damage by remainder of the row's checksum, and the number of remainders.
DROPPED, EMPTIED, UNSTOPPED, REPEATED, RENAMED, KINDS = 0, 1, 2, 3, 4, 20
#: Rows whose edits share one integer.
SEGMENT = 256

#: Digits of the edits, in ASCII order; zero is the padding.
_DIGITS = {letter: i for i, letter in enumerate("DIKR", start=1)}
_LETTERS = {i: letter for letter, i in _DIGITS.items()}
_BITS = 3
#: The grammar: what initial leads from each state to which, and the role that edits may put there.
_START, _SYSTEM, _USER, _DONE = range(4)
_NEXT = {_START: {"s": _SYSTEM, "u": _USER}, _SYSTEM: {"u": _USER}, _USER: {"a": _DONE}, _DONE: {"u": _USER}}
_GIVEN = {_START: "user", _SYSTEM: "user", _USER: "assistant", _DONE: "user"}
_ENDS = (_START, _DONE)
#: More rows than this are never worth inserting in one place: of three, two make up a pair that can go.
_INSERTED = 2

BLANK, DUPLICATE, CUT = 1, 2, 3


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, first_role, first_digest) of rows that are left, each with its checksum's damage."""
    space = F.lit(" ")
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    name = F.concat(conv_id, F.lit(":"), turn)
    slim = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       (F.crc32(name) % KINDS).alias("kind"))
    left = slim.filter(F.col("kind") != DROPPED)
    broken = F.when(F.col("kind") == EMPTIED, "").when(F.col("kind") == UNSTOPPED, F.translate("text", ".!?", ""))
    return left.select(
        "conv_id", "turn",
        F.when(F.col("kind") == RENAMED, "user").otherwise(F.col("role")).alias("role"),
        broken.otherwise(F.col("text")).alias("text"),
        F.col("role").alias("first_role"), F.unhex(F.sha2("text", 256)).alias("first_digest"),
        F.explode(F.when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


#: The order of a conversation's rows.
_ORDER = ("turn", "first_role", "first_digest", "copy")


def faults(damaged: DataFrame) -> DataFrame:
    """(conv_id, order columns, initial, fault): the first fault of every row, 0 without one."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(*[F.col(c).asc_nulls_first() for c in _ORDER])
    seen = damaged.select(
        "conv_id", *_ORDER, "role", F.unhex(F.sha2("text", 256)).alias("digest"), last.alias("last")
    ).withColumn("nth", F.row_number().over(same))
    fault = (
        F.when(F.col("last") == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
        .when(~F.col("last").isin(".", "!", "?"), CUT).otherwise(0)
    )
    return seen.select("conv_id", *_ORDER, F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _segment(rows: list[tuple[str, int]], costs: list[int | None]) -> list[tuple[int, int, int] | None]:
    """For each state before ``rows`` the least weight, taken apart: cost, digits of the edits, width of the digits.

    ``costs`` are those of the rest of the conversation, for each state after ``rows``; None where there is no way.
    """
    width = _BITS * ((_INSERTED + 1) * len(rows) + _INSERTED)
    mask = (1 << width) - 1

    def edge(weight: int | None, letter: str, cost: int) -> int | None:
        """The weight of a path after one more edit before it: digits move down by a place."""
        if weight is None:
            return None
        return ((weight >> width) + cost << width) + (_DIGITS[letter] << width - _BITS) + ((weight & mask) >> _BITS)

    def inserted(here: list[int | None]) -> list[int | None]:
        """With up to `_INSERTED` rows put in before the next edit."""
        best, ways = here, here
        for _ in range(_INSERTED):
            ways = [edge(ways[_NEXT[q][_GIVEN[q][0]]], "I", COST["I"]) for q in range(4)]
            best = [min((w for w in pair if w is not None), default=None) for pair in zip(best, ways)]
        return best

    after = inserted([None if c is None else c << width for c in costs])
    for initial, fault in reversed(rows):
        more, free = (TRUNCATED if fault == CUT else 0), fault not in (BLANK, DUPLICATE)
        here = []
        for q in range(4):
            ways = [edge(after[q], "D", COST["D"])]
            if free:
                if initial in _NEXT[q]:
                    ways.append(edge(after[_NEXT[q][initial]], "K", COST["K"] + more))
                ways.append(edge(after[_NEXT[q][_GIVEN[q][0]]], "R", COST["R"] + more))
            here.append(min((w for w in ways if w is not None), default=None))
        after = inserted(here)
    return [None if w is None else (w >> width, w & mask, width) for w in after]


def _letters(digits: int, width: int) -> str:
    out = []
    for shift in range(width - _BITS, -1, -_BITS):
        digit = digits >> shift & (1 << _BITS) - 1
        if not digit:
            break
        out.append(_LETTERS[digit])
    return "".join(out)


def audit(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of (initial, fault) in order."""
    costs, parts = [0 if q in _ENDS else None for q in range(4)], []
    starts = range(0, len(rows), SEGMENT)
    for at in reversed(starts):
        found = _segment(rows[at : at + SEGMENT], costs)
        parts.append(found)
        costs = [None if f is None else f[0] for f in found]
    state, out = _START, []
    for at, found in zip(starts, reversed(parts)):
        _, digits, width = found[state]
        out.append(letters := _letters(digits, width))
        row = at
        for letter in letters:
            if letter == "K":
                state = _NEXT[state][rows[row][0]]
            elif letter != "D":
                state = _NEXT[state][_GIVEN[state][0]]
            row += letter != "I"
    return costs[_START], "".join(out)


def _record(conv_id, rows: list[tuple[str, int]], turns: list[int]) -> tuple:
    """What is said of one conversation: counts, cost and audit. ``turns`` are distinct and rise."""
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    kinds = [sum(f == kind for _, f in rows) for kind in (BLANK, DUPLICATE, CUT)]
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:]))
    return conv_id, gaps, *kinds, illegal, *audit(rows)


_AUDITS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(found: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows."""
    kind = found.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, rows, turns, done = None, [], [], []
        for batch in batches:
            schema = batch.schema
            for conv_id, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or open_[0] != conv_id:
                    if open_ is not None:
                        done.append(_record(open_[0], rows, turns))
                    open_, rows, turns = (conv_id,), [], []
                rows.append((initial, fault))
                if turn is not None and (not turns or turns[-1] != turn):
                    turns.append(turn)
            if len(done) >= 1000:
                yield _batch(done, schema.field(0).type)
                done = []
        if open_ is not None:
            done.append(_record(open_[0], rows, turns))
        if done:
            yield _batch(done, schema.field(0).type)

    def _batch(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        types = [key, *[pa.int64()] * 6, pa.string()]
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

    sorted_ = found.repartition("conv_id").sortWithinPartitions(
        "conv_id", *[F.col(c).asc_nulls_first() for c in _ORDER]
    )
    return map_batches(
        sorted_.select("conv_id", "turn", "initial", "fault"), run, f"conv_id {kind.simpleString()}, {_AUDITS}"
    )


def repaired(damaged: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) in order of every repaired conversation, as a stream of sorted rows."""
    kind = damaged.schema["conv_id"].dataType
    return map_batches(_beside(damaged, audited), _rows, f"conv_id {kind.simpleString()}, place long, role string, text string")


def _beside(damaged: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows of a conversation in order, its audit before them."""
    none = [F.lit(None).cast(t).alias(c) for c, t in zip(_ORDER, ("long", "string", "binary", "int"))]
    heads = audited.select("conv_id", F.lit(False).alias("is_row"), *none, F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    rows = damaged.select("conv_id", F.lit(True).alias("is_row"), *_ORDER, "role", "text")
    both = heads.unionByName(rows).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "is_row", *[F.col(c).asc_nulls_first() for c in _ORDER])
    return both.select("conv_id", "is_row", "role", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired rows, and (conv_id, None, None) after the last of a conversation."""
    open_, edits, at, state = None, "", 0, _START

    def put_in():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            role = _GIVEN[state]
            at, state = at + 1, _NEXT[state][role[0]]
            yield open_[0], role, ""

    for batch in batches:
        for conv_id, is_row, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if not is_row:
                if open_ is not None:
                    yield from put_in()
                    yield open_[0], None, None
                open_, edits, at, state = (conv_id,), text, 0, _START
                continue
            yield from put_in()
            edit, at = edits[at], at + 1
            if edit == "D":
                continue
            role = _GIVEN[state] if edit == "R" else role
            state = _NEXT[state][role[0]]
            yield conv_id, role, text
    if open_ is not None:
        yield from put_in()
        yield open_[0], None, None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, out, place = pa.null(), [], 0

    def typed(batches):
        nonlocal key
        for batch in batches:
            key = batch.schema.field(0).type
            yield batch

    def packed() -> pa.RecordBatch:
        types = [key, pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", "place", "role", "text"])

    for conv_id, role, text in _edited(typed(batches)):
        if role is None:
            place = 0
            continue
        out.append((conv_id, place, role, text))
        place += 1
        if len(out) >= 1000:
            yield packed()
            out = []
    if out:
        yield packed()


def digests(damaged: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of `repaired`'s ``role:text``, joined by line feeds."""
    kind = damaged.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, done, digest, first = pa.null(), [], hashlib.sha256(), True

        def typed(batches):
            nonlocal key
            for batch in batches:
                key = batch.schema.field(0).type
                yield batch

        def packed() -> pa.RecordBatch:
            ids, found = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(ids, key), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

        for conv_id, role, text in _edited(typed(batches)):
            if role is None:
                done.append((conv_id, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(done) >= 1000:
                    yield packed()
                    done = []
                continue
            digest.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
            first = False
        if done:
            yield packed()

    return map_batches(_beside(damaged, audited), run, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Counts of faults, cost, audit and digest of every conversation of (conv_id, turn, role, text), after `damage`."""
    damaged = damage(rows)
    audited = written(audits(faults(damaged)), "audits")
    hashed = digests(damaged, audited)
    names = rows.select(F.col("conv_id").alias("id")).distinct()
    both = audited.join(hashed, audited["conv_id"].eqNullSafe(hashed["conv_id"])).drop(hashed["conv_id"])
    out = names.join(both, F.col("id").eqNullSafe(F.col("conv_id")), "left")

    def or_else(column: str, value) -> Column:
        return F.coalesce(column, F.lit(value)).alias(column)

    counts = [or_else(c, 0) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return out.select(F.col("id").alias("conv_id"), *counts, or_else("audit", ""), or_else("repaired_sha256", empty))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `conversations`, damaged and repaired."""
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
