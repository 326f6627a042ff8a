"""Near copies by exact Jaccard similarity: texts that share ``LEAST`` or more of their 5-word shingles.

Words are in lower case (A-Z). Candidates come from a prefix filter: with all shingles in one order, two sets
that are similar enough have a shingle in common among the first ``n - ceil(LEAST * n) + 1`` of both. The order
is that of the shingles' hashes, frequent shingles last; any order finds every pair, this one finds few others.

A shingle's texts of like size are first compared with the shortest of them, which joins most of a group of near copies
by as many comparisons as it has members. Only texts of one shingle that are in different components after that
are compared in pairs, where their sizes and the places of the shingle allow the similarity. Where a shingle has
many such texts, they must have a second one in common too, further on in the order, and so on up to `DEEP`:
similar texts that differ share as many. So one line that many unlike texts have doesn't make all pairs of them.
Every comparison is of whole sets, which are made again from the texts that are compared.

Edge cases: all texts without words (null, empty, blanks) are alike; one with fewer words than a shingle is one
shingle; a text is read whole, however long; repeated rows are cut to one; a null id is kept only if all ids of its
component are null; an empty table gives an empty result; other columns are handed on, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.components import components
from lodeworks.llm.frames import map_batches, text_of, written
from lodeworks.llm.simhash import SEED, only, shingles

SHINGLE = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Shingles known to be frequent at most, and the hashes counted together to find them.
HEAVY, COUNTED = 100_000, 1 << 22
#: Bins of the filters that spare most rows a shuffle.
BINS = 1 << 24
#: Shingles that similar texts have in common at least, unless they have the same; with more than ``CROWD`` texts to
#: compare, this many of them are asked for one after another. Fewer texts are sooner compared than dealt anew.
DEEP, CROWD = 4, 512
#: Texts that one task compares with the same one.
COMPARED = 2000


def alike(shared: Column, n: Column, m: Column) -> Column:
    """Whether sets of n and m members with so many in common, or so many at most, reach ``LEAST``."""
    part, whole = LEAST
    return (part + whole) * shared.cast("long") >= part * (n.cast("long") + m.cast("long"))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_of()).alias("key"),
        text_of().cast("binary").alias("body"),
    )


def _set(body: bytes) -> np.ndarray:
    """The hashes of a text's shingles, ascending, each once."""
    return np.unique(np.array(shingles(body, SHINGLE), np.uint64))


def _node(hashes: np.ndarray) -> int:
    """One number for all texts with these shingles, signed."""
    node = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
    return node - (node >> 63 << 64)


def _parts(batch: pa.RecordBatch, column: int, rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield part, [_set(t.as_py()) for t in part.column(column)]


def _frequent(slim: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and their order among each other from 1; a hint, not a full count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
            parts.clear()
            often = counts > 3
            return pa.RecordBatch.from_arrays([pa.array(hashes[often].view(np.int64)), pa.array(counts[often])], ["hash", "uses"])

        for batch in batches:
            for _, found in _parts(batch, 0):
                parts += found
                if sum(map(len, parts)) >= COUNTED:
                    yield counted()
        if parts:
            yield counted()

    uses = map_batches(slim.select("body"), run, "hash long, uses long").groupBy("hash").agg(F.sum("uses").alias("uses"))
    top = uses.orderBy(F.col("uses").desc(), "hash").limit(most).collect()
    hashes = np.array([r["hash"] for r in top], np.int64)
    order = np.argsort(hashes)
    return hashes[order], (len(top) - np.arange(len(top)))[order]


def prefixes(docs: DataFrame, heavy: int) -> DataFrame:
    """(id, key, node, n, prefix) of every row: the shingles by which a set is found, and `DEEP` - 1 more, in order.

    Equal sets have one node and n members; key tells rows of one id apart. Sets themselves are not kept, as they are
    larger than the texts: the few that are compared are made again.
    """
    slim = _slim(docs)
    known, ranks = _frequent(slim, heavy)

    def first(hashes: np.ndarray) -> np.ndarray:
        part, whole = LEAST
        few = len(hashes) - -(-part * len(hashes) // whole) + DEEP
        flat, rank = hashes.view(np.int64), np.zeros(len(hashes), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
            rank = np.where(known[at] == flat, ranks[at], 0)
        return flat[np.lexsort((flat, rank))[:few]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in _parts(batch, 2):
                taken = [first(x) for x in found]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in taken])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(taken)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2], pa.array([_node(x) for x in found], pa.int64()),
                        pa.array([len(x) for x in found], pa.int32()), lists,
                    ],
                    ["id", "key", "node", "n", "prefix"],
                )

    return map_batches(slim, run, "id long, key long, node long, n int, prefix array<long>")


def _meeting(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column`` may be in the ``column`` of ``wanted``: all that are, few others.

    Both columns hold hashes. The driver gets ``BINS`` numbers at most, a bit per bin goes to the tasks.
    """
    seen = np.zeros(BINS, bool)
    bins = wanted.select(F.col(column).bitwiseAND(F.lit(BINS - 1)).cast("int").alias("bin")).distinct()
    seen[bins.toArrow()["bin"].to_numpy()] = True
    bits, at = np.packbits(seen), rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(known[batch.column(at).to_numpy() & (BINS - 1)]))

    return map_batches(rows, run, ", ".join(f"{c} {kind}" for c, kind in rows.dtypes))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike.

    A text that is compared with many goes to as many tasks as these need; a task holds two sets at a time.
    """
    pairs = written(pairs.distinct(), "pairs")
    turns = pairs.groupBy("a").agg(F.ceil(F.count("*") / COMPARED).alias("turns"))
    dealt = pairs.join(turns, "a").withColumn("turn", F.pmod(F.xxhash64("b"), F.col("turns")))
    firsts = turns.select("a", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.col("a").alias("b"))
    sent = written(dealt.select("a", "turn", "b").union(firsts), "sent")
    ends = written(sent.select(F.col("b").alias("node")).distinct().join(nodes.select("node", F.col("least.key").alias("key")), "node"), "ends")
    texts = _meeting(_slim(docs).select("key", "body"), "key", ends).join(ends, "key").dropDuplicates(["node"])
    rows = sent.join(texts.select(F.col("node").alias("b"), "body"), "b")
    rows = rows.repartition("a", "turn").sortWithinPartitions("a", "turn", F.col("a") != F.col("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, whole = LEAST
        first = None
        for batch in batches:
            found = []
            for a, b, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                hashes = _set(body.as_py())
                if a == b:
                    first = hashes
                    continue
                shared = len(np.intersect1d(first, hashes, assume_unique=True))
                if (part + whole) * shared >= part * (len(first) + len(hashes)):
                    found.append((a, b))
            ends = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return written(map_batches(rows.select("a", "b", "body"), run, "a long, b long"), "alike")


def _few(n: Column) -> Column:
    """How many of n shingles, in order, a similar set has one of."""
    part, whole = LEAST
    return n - F.floor((part * n + whole - 1) / whole).cast("int") + 1


def _entries(nodes: DataFrame) -> DataFrame:
    """(hash, node, n, at, band): a row for each shingle that a set is found by; sizes in one band may be alike."""
    part, whole = LEAST
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(whole / part)).cast("int")
    few = nodes.select("node", "n", band.alias("band"), F.posexplode(F.slice("prefix", F.lit(1), _few(F.col("n")))))
    return few.select(F.col("col").alias("hash"), "node", "n", F.col("pos").alias("at"), "band")


def _deeper(crowd: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """Texts of one key by a further shingle in common: key, and ``at`` of the last one."""
    more = crowd.join(nodes.select(F.col("node").alias("of"), "prefix"), F.col("node") == F.col("of"))
    rest = F.slice("prefix", F.col("at") + 2, F.greatest(F.lit(0), _few(F.col("n")) + F.lit(level - 1) - F.col("at") - 1))
    more = more.select("*", F.posexplode(rest))
    key = F.xxhash64("hash", F.col("col")).alias("hash")
    more = more.select(key, "node", "n", (F.col("at") + 1 + F.col("pos")).cast("int").alias("at"), "band", "part")
    return written(_apart(written(more, "further"))[0], "deeper")


def _apart(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash has texts of more than one component, and how many rows it has."""
    sizes = rows.groupBy("hash").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.count("*").alias("texts"))
    sizes = sizes.filter("x < y").select("hash", "texts")
    return rows.join(sizes, "hash"), sizes


def _pairs(rows: DataFrame, before: int) -> DataFrame:
    """Pairs (a, b) of one hash and different components whose sizes and places allow the similarity.

    A key speaks of so many common shingles ``before`` the one whose place it has.
    """
    part, whole = LEAST
    a, b = (rows.select(*[F.col(c).alias(f"{c}_{end}") for c in ("hash", "node", "n", "at", "part", "band")]) for end in "ab")
    # Sizes that are alike are in one band or in neighbouring ones.
    b = b.withColumn("band_b", F.explode(F.array(F.col("band_b") - 1, "band_b", F.col("band_b") + 1)))
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) + before
    both = a.join(
        b, (F.col("hash_a") == F.col("hash_b")) & (F.col("band_a") == F.col("band_b")) & (F.col("node_a") < F.col("node_b"))
        & (F.col("part_a") != F.col("part_b")) & alike(rest, F.col("n_a"), F.col("n_b")),
    )
    return both.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (a, b) between ``nodes`` that connect exactly what chains of similar sets connect."""
    entries = _entries(nodes)
    often = written(entries.groupBy("hash").count().filter("count > 1").select("hash"), "often")
    shared = written(_meeting(entries, "hash", often).join(often, "hash"), "shared")
    heads = shared.groupBy("hash", "band").agg(F.min(F.struct("n", "node", "at")).alias("head"), F.count("*").alias("texts"))
    heads = heads.filter("texts > 1").select("hash", "band", "head")
    least = F.least(F.col("head.n") - F.col("head.at"), F.col("n") - F.col("at"))
    stars = shared.join(heads, ["hash", "band"]).filter((F.col("node") != F.col("head.node")) & alike(least, F.col("head.n"), F.col("n")))
    edges = _verified(stars.select(F.col("head.node").alias("a"), F.col("node").alias("b")), nodes, docs)
    named = components(edges).withColumnRenamed("node", "member")
    placed = shared.join(named, F.col("node") == F.col("member"), "left")
    placed = placed.select("hash", "node", "n", "at", "band", F.coalesce("component", "node").alias("part"))
    rows = written(_apart(written(placed, "placed"))[0], "apart")
    # What of each level is compared in pairs: keys of few texts, and of the last level all.
    others = None
    for level in range(2, DEEP + 2):
        last = level > DEEP
        found = _pairs(rows if last else rows.filter(F.col("texts") <= CROWD), level - 2)
        others = found if others is None else others.union(found)
        crowd = rows.filter(F.col("texts") > CROWD).drop("texts")
        if last or crowd.isEmpty():
            break
        rows = _deeper(crowd, nodes, level)
    return edges.union(_verified(others, nodes, docs))


def keep(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """One row of each component of near copies stays, with the columns of ``docs``: that of the smallest id."""
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least")
    nodes = prefixes(docs, heavy).groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"), least)
    nodes = written(nodes, "nodes")
    return heads(docs, nodes, links(nodes, docs))


def heads(docs: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have the least id of each component of ``nodes`` under ``edges``."""
    named = components(written(edges, "links")).withColumnRenamed("node", "member")
    least = nodes.select("node", "least").join(named, F.col("node") == F.col("member"), "left")
    least = least.groupBy(F.coalesce("component", "node").alias("part")).agg(F.min("least").alias("head"))
    return only(docs, least.select(F.col("head.id").alias("component_id"), F.col("head.key").alias("key")))
