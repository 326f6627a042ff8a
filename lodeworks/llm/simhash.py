"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has a bit set when it is set in over half of the XXH64 hashes of the text's 3-word
shingles. Equal fingerprints are compared once. The distinct ones are laid out in cells by the number of
set bits in each quarter of the fingerprint; two fingerprints within the radius have bit counts that
differ, summed over the quarters, by no more than the radius, so only tiles of cells so close are
compared, the others are skipped. A cell that holds more than ``TILE`` fingerprints is dealt over as many
tiles as it needs. Tiles are compared whole, by numpy exclusive-or and bit counts; what a pair of tiles
yields is a spanning forest of its links, not the links themselves, so a large group of near copies
yields about one row per member. Components are then found by rounds of joins.

Edge cases: a text without words (null, empty, blanks) has fingerprint zero, linked like any other; one
with fewer words than a shingle is one shingle; repeated rows have equal fingerprints and one component;
a null id is carried but never names a component unless all ids of it are null; very long texts are read
whole; other columns are handed on by `keep`, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.components import components
from lodeworks.llm.frames import boxed, documents, map_batches, text_of, unboxed, written

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a tile; 64 KB together.
TILE = 4096
QUARTER = 16


def shingles(text: bytes, size: int = SHINGLE) -> list[int]:
    """Hashes of each ``size`` neighbouring words; of fewer words, or none, a single one."""
    words = text.lower().split()
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    row, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-size].tolist()]
    return [digest(row[s:e], SEED) for s, e in zip(starts, (ends[size - 1 :] - 1).tolist())]


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of a whole text, unsigned."""
    if not text or text.isspace():
        return 0
    hashes = shingles(text, size)
    table = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(table), 8192):
        ones += np.unpackbits(table[at : at + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(table)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, key, fp) of every row; key hashes the text and tells rows of one id apart, fp is a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py()) for text in batch.column(2)]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(signed)], ["id", "key", "fp"])

    slim = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_of()).alias("key"),
        text_of().cast("binary").alias("body"),
    )
    return map_batches(slim, run, "id long, key long, fp long")


def _names(rows: np.ndarray, cols: np.ndarray, n: int, m: int) -> np.ndarray:
    """Components of a block's links: for its n rows and then its m columns the smallest node linked by a chain."""
    name = np.arange(n + m)
    cols = cols + n
    while True:
        was = name.copy()
        np.minimum.at(name, rows, was[cols])
        np.minimum.at(name, cols, name[rows])
        name = name[name]
        if np.array_equal(name, was):
            return name


def forest(left: np.ndarray, right: np.ndarray, radius: int, cells: int = 1 << 18) -> list[tuple[int, int]]:
    """Edges that connect what the links between two tiles connect; ``right`` may be ``left``.

    Blocks of about ``cells`` comparisons stay in the processor's cache. Each block's links are first cut
    to its components, so that only a row per fingerprint goes on, however dense the links are.
    """
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.get(top, top) != top:
            top = root[top]
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    block = max(1, cells // max(1, len(right)))
    for at in range(0, len(left), block):
        part = left[at : at + block]
        rows, cols = np.nonzero(np.bitwise_count(part[:, None] ^ right[None, :]) <= radius)
        if len(rows):
            nodes = np.concatenate([part, right])
            name = _names(rows, cols, len(part), len(right))
            moved = np.flatnonzero(name != np.arange(len(name)))
            for a, b in zip(nodes[moved].tolist(), nodes[name[moved]].tolist()):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
    return [(find(x), x) for x in list(root) if find(x) != x]


def _offsets(radius: int) -> list[list[int]]:
    """Differences of four bit counts that sum to the radius at most; of each and its opposite, one."""
    reach = range(-radius, radius + 1)
    close = [(a, b, c, d) for a in reach for b in reach for c in reach for d in reach
             if abs(a) + abs(b) + abs(c) + abs(d) <= radius]
    return [list(o) for o in close if o >= (0, 0, 0, 0)]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) over distinct fingerprints that connect exactly those linked by chains within ``radius``."""
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", QUARTER * i).bitwiseAND(F.lit((1 << QUARTER) - 1))).cast("int")
        for i in range(4)
    ]
    placed = distinct.select("fp", F.array(*counts).alias("cell"))
    # At most 17^4 cells, whatever the number of fingerprints.
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    placed = placed.join(F.broadcast(sizes), "cell")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    tiles = written(placed.groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")), "tiles")
    offsets = F.array(*[F.array(*[F.lit(x) for x in o]) for o in _offsets(radius)])
    near = F.zip_with("cell", "offset", lambda x, y: x + y)
    sent = tiles.withColumn("offset", F.explode(offsets)).select(
        F.col("cell").alias("from"), F.col("part").alias("from_part"), F.col("fps").alias("others"), near.alias("cell")
    )
    sent = sent.filter(F.forall("cell", lambda x: x.between(0, QUARTER)))
    pairs = sent.join(tiles, "cell").filter(
        (F.col("from") != F.col("cell")) | (F.col("from_part") <= F.col("part"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in zip(batch.column(0), batch.column(1)):
                a, b = (x.values.to_numpy().view(np.uint64) for x in (a, b))
                found += forest(a, b, radius)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return map_batches(pairs.select("others", "fps"), run, "a long, b long")


def classes(stamped: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id, key): for each distinct fingerprint of (id, key, fp) what its component keeps.

    That is the row with the smallest id and, among those, the smallest key.
    """
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("least")
    distinct = written(stamped.groupBy("fp").agg(least), "distinct")
    named = components(written(links(distinct.select("fp"), radius), "links"))
    placed = distinct.join(named, distinct["fp"] == named["node"], "left")
    placed = written(placed.select("fp", "least", F.coalesce("component", "fp").alias("component")), "placed")
    heads = written(placed.groupBy("component").agg(F.min("least").alias("head")), "heads")
    heads = placed.join(heads, "component")
    return written(heads.select("fp", F.col("head.id").alias("component_id"), F.col("head.key").alias("key")), "classes")


def keep(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component stays, with the columns of ``docs``: that of the smallest id.

    Rows that repeat both id and text are cut to one.
    """
    return only(docs, classes(written(fingerprints(docs), "fingerprints"), radius))


def only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that (component_id, key) name, each once."""

    def key(row_id: str, text_key: Column) -> Column:
        return F.concat(F.coalesce(F.col(row_id).cast("long").cast("string"), F.lit("")), F.lit(":"), text_key)

    # One key column, so that the window needs no shuffle beyond the join's.
    chosen = chosen.select(key("component_id", F.col("key").cast("string")).alias("at")).distinct()
    marked = docs.select(boxed(docs), key("doc_id", F.xxhash64(text_of()).cast("string")).alias("at"))
    kept = marked.join(chosen, "at", "left_semi")
    once = Window.partitionBy("at").orderBy(F.lit(0))
    return unboxed(kept.withColumn("copy", F.row_number().over(once)).filter("copy = 1"), docs.columns)


def op3_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents` with fingerprint and component."""
    stamped = written(fingerprints(documents(spark, sf_dir)), "fingerprints")
    return stamped.join(classes(stamped).drop("key"), "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
