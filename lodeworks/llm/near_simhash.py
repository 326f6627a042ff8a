"""SimHash near copies: texts that share 0.8 or more of their 5-word shingles, found by their fingerprints.

A text's fingerprint has 256 bits, each set when it is set in over half of the hashes of the text's set of shingles:
those are XXH64, whose bits are the first quarter, and three mixtures of it. Sets that share ``LEAST`` of their members
differ in 0.19 of the bits at most on the average (sets of 4 and 5), and larger ones in 0.16; the radius lies four or
more standard deviations above, where unlike texts, which differ in half of the bits, don't come.

Equal sets are compared once. Fingerprints are laid out in tiles by the sizes of their sets: sizes that allow the
similarity are in one band or in neighbouring ones, only tiles of such bands are compared, the others are skipped. Tiles
are compared whole, by numpy exclusive-or and bit counts, first of half of the bits. In a first round each fingerprint
yields its nearest one of each tile only. Texts of these pairs are compared exactly, as `near_copies` does it, and what
is alike is joined, which takes in most of a large group by about one comparison per member. In the second round those
that had any within the radius are compared again, and all pairs of different components are compared exactly, in squares of
`SIDE` by `SIDE` texts: a text is sent once for all its pairs of a square, and a square yields a spanning forest.

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
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm import near_copies
from lodeworks.llm.components import components
from lodeworks.llm.frames import map_batches, written
from lodeworks.llm.near_copies import LEAST
from lodeworks.llm.simhash import SEED

WORDS = [f"f{i}" for i in range(4)]
#: Bits that may differ, of 256; for sets of fewer than ``SMALL`` members, which differ in more; of the first 128.
RADIUS, SMALL_RADIUS, SMALL, HALF_RADIUS = 72, 80, 6, 46
#: Fingerprints of a tile, and comparisons of a block, which stays in the processor's cache.
TILE, CELLS = 1 << 14, 1 << 17
#: Texts on a side of a square, whose pairs one task compares.
SIDE = 256
#: Tasks that compare tiles, at most.
TASKS = 4096
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The four words of the fingerprint of a set of hashes."""
    words = [hashes]
    for odd in _MIX:
        x = hashes * np.uint64(odd)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX[0])
        words.append(x ^ (x >> np.uint64(29)))
    table = np.stack(words, axis=1).astype(">u8").view(np.uint8)
    ones = np.zeros(256, np.int64)
    for at in range(0, len(table), 8192):
        ones += np.add.reduce(np.unpackbits(table[at : at + 8192], axis=1), axis=0, dtype=np.uint16)
    return np.packbits(2 * ones > len(table)).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, key, node, n, f0 to f3) of every row: node names its set of n shingles, key tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in near_copies._parts(batch, 2):
                words = np.array([fingerprint(x) for x in found]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2], pa.array([near_copies._node(x) for x in found], pa.int64()),
                        pa.array([len(x) for x in found], pa.int32()), *[pa.array(w) for w in words.T.copy()],
                    ],
                    ["id", "key", "node", "n", *WORDS],
                )

    kinds = ", ".join(f"{w} long" for w in WORDS)
    return map_batches(near_copies._slim(docs), run, f"id long, key long, node long, n int, {kinds}")


def _nearest(at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """For each value of ``at`` the index of a least of ``bits``."""
    order = np.argsort(bits, kind="stable")
    return order[np.unique(at[order], return_index=True)[1]]


def _limits() -> tuple[int, ...]:
    """What the driver's settings say, for tasks."""
    return RADIUS, SMALL_RADIUS, HALF_RADIUS, CELLS


def close(left: dict[str, np.ndarray], right: dict[str, np.ndarray], same: bool, limits: tuple[int, ...] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, column, bits that differ) of the pairs of two tiles that may be alike and are of different parts.

    With ``same`` a tile is compared with itself, each pair once.
    """
    part, whole = LEAST
    radius, small_radius, half_radius, cells = limits or _limits()
    width = len(right["node"])
    block = max(1, cells // width)
    # Made once: fresh memory would cost more than the comparisons.
    bits, apart, half = np.empty((block, width), np.uint64), *np.empty((2, block, width), np.uint8)
    for start in range(0, len(left["node"]), block):
        size = min(block, len(left["node"]) - start)
        for w, to in ((WORDS[0], half), (WORDS[1], apart)):
            np.bitwise_xor(left[w][start : start + size, None], right[w][None, :], out=bits[:size])
            np.bitwise_count(bits[:size], out=to[:size])
        half[:size] += apart[:size]
        rows, cols = np.divmod(np.flatnonzero(half[:size] <= half_radius), width)
        rows += start
        n, m = left["n"][rows], right["n"][cols]
        fit = (whole * np.minimum(n, m) >= part * np.maximum(n, m)) & (left["part"][rows] != right["part"][cols])
        if same:
            fit &= rows < cols
        rows, cols = rows[fit], cols[fit]
        differ = sum(np.bitwise_count(left[w][rows] ^ right[w][cols]).astype(np.int64) for w in WORDS)
        small = np.minimum(left["n"][rows], right["n"][cols]) < SMALL
        near = differ <= np.where(small, small_radius, radius)
        if near.any():
            yield rows[near], cols[near], differ[near]


def _nearest_of_tiles(left: dict[str, np.ndarray], right: dict[str, np.ndarray], same: bool, limits: tuple[int, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the pairs that `close` finds, one that is nearest for each row and one for each column."""
    bits, rows = np.full(len(right["node"]), 257), np.zeros(len(right["node"]), np.int64)
    for i, j, apart in close(left, right, same, limits):
        least = _nearest(i, apart)
        yield i[least], j[least]
        least = _nearest(j, apart)
        least = least[apart[least] < bits[j[least]]]
        bits[j[least]], rows[j[least]] = apart[least], i[least]
    met = np.flatnonzero(bits < 257)
    yield rows[met], met


def _tile_pairs(nodes: DataFrame) -> DataFrame:
    """(rows, others, same) of ``nodes`` (node, part, n, f0 to f3): every two tiles whose sizes may be alike."""
    part, whole = LEAST
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(whole / part)).cast("int")
    placed = nodes.select("node", "part", "n", *WORDS, band.alias("band"))
    # A row per band, of which there are as many as sizes have powers of 1.25.
    sizes = written(placed.groupBy("band").agg(F.ceil(F.count("*") / TILE).alias("tiles")), "sizes")
    placed = placed.join(F.broadcast(sizes), "band").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    rows = F.collect_list(F.struct("node", "part", F.col("n").cast("long").alias("n"), *WORDS))
    tiles = written(placed.groupBy("band", "tile").agg(rows.alias("rows")), "tiles")
    ours = sizes.select("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"))
    theirs = ours.select(F.col("band").alias("other_band"), F.col("tile").alias("other"))
    one, two = F.col("other_band") - F.col("band"), F.col("tile") <= F.col("other")
    pairs = written(ours.join(theirs, (one == 1) | ((one == 0) & two)), "tile-pairs")
    pairs = pairs.repartition(max(1, min(pairs.count(), TASKS)), "band", "tile", "other_band", "other")
    others = tiles.select(F.col("band").alias("other_band"), F.col("tile").alias("other"), F.col("rows").alias("others"))
    met = pairs.join(tiles, ["band", "tile"]).join(others, ["other_band", "other"])
    same = (F.col("band") == F.col("other_band")) & (F.col("tile") == F.col("other"))
    return met.select("rows", "others", same.alias("same"))


def _tiles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], dict[str, np.ndarray], bool]]:
    def taken(rows: pa.ListScalar) -> dict[str, np.ndarray]:
        rows = rows.values
        words = {w: rows.field(w).to_numpy().view(np.uint64) for w in WORDS}
        return {**{c: rows.field(c).to_numpy() for c in ("node", "part", "n")}, **words}

    for batch in batches:
        for left, right, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
            yield taken(left), taken(right), same


def nearest(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` within the radius: for each and each tile a nearest one."""
    limits = _limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, same in _tiles_of(batches):
            for i, j in _nearest_of_tiles(left, right, same, limits):
                a, b = left["node"][i], right["node"][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return map_batches(_tile_pairs(nodes), run, "a long, b long").distinct()


def squares(nodes: DataFrame) -> DataFrame:
    """All pairs of ``nodes`` within the radius and of different parts: (square, a, b), of `SIDE` by `SIDE` texts.

    A square's pairs are those of the same places of the lists a and b.
    """
    limits, side = _limits(), SIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for left, right, same in _tiles_of(batches):
            # Texts of a component lie together, so that large groups fill few squares.
            left, right = ({c: v[order] for c, v in t.items()} for t in (left, right) for order in [np.lexsort((t["node"], t["part"]))])
            strip, rows, cols = 0, [], []

            def done() -> Iterator[pa.RecordBatch]:
                i, j = np.concatenate(rows), np.concatenate(cols)
                at = np.lexsort((j // side, i // side))
                i, j = i[at], j[at]
                cuts = np.flatnonzero(np.diff(i // side) | np.diff(j // side)) + 1
                for x, y in zip(np.split(left["node"][i], cuts), np.split(right["node"][j], cuts)):
                    name = xxhash.xxh64_intdigest(x.tobytes() + y.tobytes(), SEED)
                    lists = [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (x, y)]
                    yield pa.RecordBatch.from_arrays([pa.array([name - (name >> 63 << 64)]), *lists], ["square", "a", "b"])

            for i, j, _ in close(left, right, same, limits):
                if rows and i[0] // side > strip:
                    yield from done()
                    rows.clear(), cols.clear()
                strip = i[-1] // side
                rows.append(i), cols.append(j)
            if rows:
                yield from done()

    return map_batches(_tile_pairs(nodes), run, "square long, a array<long>, b array<long>")


def _joined(found: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what the alike pairs of each of the `squares` connect; a task holds a square's texts."""
    found = written(found, "squares")
    wanted = found.select("square", F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    wanted = wanted.join(nodes.select("node", F.col("least.key").alias("key")), "node")
    wanted = written(wanted, "wanted")
    slim = near_copies._meeting(near_copies._slim(docs).select("key", "body"), "key", wanted)
    texts = slim.dropDuplicates(["key"]).join(wanted, "key").select("square", "node", "body")

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        part, whole = LEAST
        sets = {n: near_copies._set(t.as_py()) for n, t in zip(texts["node"].to_pylist(), texts["body"])}
        root = {n: n for n in sets}

        def top(n: int) -> int:
            while root[n] != n:
                root[n] = n = root[root[n]]
            return n

        edges = []
        for a, b in zip(pairs["a"].combine_chunks().flatten().to_pylist(), pairs["b"].combine_chunks().flatten().to_pylist()):
            if top(a) == top(b):
                continue
            x, y = sets[a], sets[b]
            shared = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
            if (part + whole) * shared >= part * (len(x) + len(y)):
                root[top(a)] = top(b)
                edges.append((a, b))
        ends = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return found.groupBy("square").cogroup(texts.groupBy("square")).applyInArrow(run, "a long, b long")


def links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (a, b) between ``nodes`` that connect what chains of similar sets within the radius connect."""
    first = written(nearest(nodes.withColumn("part", F.col("node"))), "nearest")
    edges = near_copies._verified(first, nodes, docs)
    named = components(edges).withColumnRenamed("node", "member")
    met = first.select(F.col("a").alias("node")).union(first.select("b")).distinct()
    placed = nodes.join(met, "node").join(named, F.col("node") == F.col("member"), "left")
    placed = written(placed.select("node", "n", *WORDS, F.coalesce("component", "node").alias("part")), "placed")
    return edges.union(_joined(squares(placed), nodes, docs))


def keep(docs: DataFrame) -> DataFrame:
    """One row of each component of near copies stays, with the columns of ``docs``: that of the smallest id."""
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least")
    values = [F.any_value(c).alias(c) for c in ("n", *WORDS)]
    nodes = written(fingerprints(docs).groupBy("node").agg(*values, least), "nodes")
    return near_copies.heads(docs, nodes, links(nodes, docs))
