"""Hard negatives by inner product, with candidates from sorted coordinate lists (LEMP).

Rows are sorted by length and cut into buckets, and a bucket into parts. In each part the directions of its rows,
that is rows over their lengths, are listed by the value of each coordinate. An anchor that needs a score of at least
``s`` needs a cosine of at least ``s`` over its length and the part's largest; for a row that reaches it, each
coordinate lies in a range that follows from the cosine and the anchor's own value there. The ranges of the anchor's
few largest coordinates, its focus, are looked up in their lists; rows that all of them name are candidates, and only
these are verified by exact integer inner products. The score that an anchor needs rises as a bucket is worked off, from
its longest rows down; parts whose longest rows can't reach it are passed over, and so are lists whose range holds
the whole part, as of no use.

Anchors meet buckets in blocks: each block of anchors is sent to each bucket, found by an equi-join on the bucket's
number, and a task holds one bucket and one block. A bucket gives a few rows for an anchor; windows over these give
the first of all. First positives are sought, then, with their scores as bounds, negatives.

Numbers are exact: components are integers, and of single, double or unlimited precision the least is used that holds
the product of the lengths, which no partial sum of an inner product exceeds.

Edge cases: rows with a null label, a null vector, or any null or non-finite component take no part, nor do those
with a null id; a vector that is shorter than another counts as zero beyond its end, and one without components
scores 0 with all; repeated rows are rows of their own, and every row of an anchor's id is an anchor, but none is a
positive of another row with its id; scores beyond the range of long are cut to its ends; an empty table
gives an empty result; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.frames import map_batches, written

#: Anchors are rows whose id is divisible by this; each has so many positives, and a pair so many negatives.
ANCHORS, POSITIVES, NEGATIVES = 100, 5, 5
#: A negative's score is at least this many hundredths of the positive's.
LEAST = 80
#: Bytes of a bucket's components and of an anchor block's, rows of a part, and coordinates of a focus.
BUCKET, BLOCK, PART, FOCUS = 4 << 20, 1 << 20, 2048, 3

_LONG = 2**63 - 1
_PACKED = "bucket long, n int, dims int, ids binary, labels binary, vectors binary"


# -- rows in buckets -------------------------------------------------------------------


def quantised(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, length, vector): rows that take part, with integer components as doubles, longest first of use."""
    parts = F.col(vector).cast("array<double>")
    finite = F.forall("parts", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), parts.alias("parts"))
    slim = slim.filter("vec_id IS NOT NULL AND label IS NOT NULL AND parts IS NOT NULL").filter(finite)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.floor(256 * np.array(v, np.float64)) for v in batch.column(2).to_pylist()]
            with np.errstate(over="ignore"):
                lengths = [_length(v) for v in vectors]
            columns = [batch.column(0), batch.column(1), pa.array(lengths, pa.float64()), pa.array([v.tobytes() for v in vectors], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "length", "vector"])

    return map_batches(slim.select("vec_id", label.alias("label"), "parts"), run, "vec_id long, label long, length double, vector binary")


def _length(v: np.ndarray) -> float:
    """No less than the Euclidean length, whatever the rounding."""
    most = float(np.abs(v).max(initial=0.0))
    return 0.0 if not most else most * math.sqrt(float(((v / most) ** 2).sum())) * (1 + 1e-12)


def buckets(rows: DataFrame, size: int | None = None) -> DataFrame:
    """Rows of `quantised` packed by falling length, so that a bucket's are of like length; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = size or BUCKET
        task, nth, ids, labels, vectors, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def packed() -> pa.RecordBatch:
            dims = max(map(len, vectors)) // 8
            padded = b"".join(v.ljust(8 * dims, b"\0") for v in vectors)
            cells = [(task << 32) + nth, len(ids), dims, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), padded]
            return _record([cells])

        for batch in batches:
            for vec_id, label, vector in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and held + len(vector) + 16 > most:
                    yield packed()
                    nth, ids, labels, vectors, held = nth + 1, [], [], [], 0
                ids.append(vec_id)
                labels.append(label)
                vectors.append(vector)
                held += len(vector) + 16
        if ids:
            yield packed()

    ordered = rows.repartitionByRange(F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    return written(map_batches(ordered.select("vec_id", "label", "vector"), run, _PACKED), "vector-buckets")


def _record(rows: list[list]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "n", "dims", "ids", "labels", "vectors"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


class Bucket:
    """Rows as arrays, longest first; ``rows`` are integers as doubles."""

    def __init__(self, dims: int, ids: bytes, labels: bytes, vectors: bytes):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.rows = np.frombuffer(vectors, "<f8").reshape(len(self.ids), dims)

    def parts(self, rows: int | None = None) -> Iterator[Part]:
        rows = rows or PART
        for at in range(0, len(self.ids), rows):
            yield Part(self.ids[at : at + rows], self.labels[at : at + rows], self.rows[at : at + rows])


class Part:
    """A run of a bucket's rows with lists of their directions by coordinate, sorted when they are first looked up."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.lengths = np.array([_length(r) for r in rows])
        self.directions = rows / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.least, self.most = (f(self.directions, 0, initial=0.0) for f in (np.min, np.max))
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def listed(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """The part's values of a coordinate in order, and whose they are."""
        if coordinate not in self._lists:
            order = np.argsort(self.directions[:, coordinate], kind="stable")
            self._lists[coordinate] = self.directions[order, coordinate], order
        return self._lists[coordinate]

    def candidates(self, direction: np.ndarray, cosine: float, focus: np.ndarray) -> np.ndarray | None:
        """Rows that may have a cosine of at least ``cosine`` with an anchor's direction; None for all of them.

        With the rest of two directions as alike as can be, ``p * q + sqrt((1 - p²)(1 - q²)) >= cosine`` bounds p.
        """
        if cosine <= 0:
            return None
        named, used = None, 0
        for f in focus.tolist():
            q = min(1.0, max(-1.0, float(direction[f])))
            spread = math.sqrt(max(0.0, (1 - cosine * cosine) * (1 - q * q))) + 1e-9
            # The other end is no bound where all of the range beyond is reached too.
            low = -1.0 if -q >= cosine else q * cosine - spread
            high = 1.0 if q >= cosine else q * cosine + spread
            if low <= self.least[f] and high >= self.most[f]:
                continue
            values, order = self.listed(f)
            found = order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
            if named is None:
                named = np.zeros(len(self.ids), np.uint8)
            named[found] += 1
            used += 1
        return None if named is None else np.flatnonzero(named == used)


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, (row, anchor), the shorter kind filled with zeros."""
    dims = max(rows.shape[1], anchors.shape[1])
    rows, anchors = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) if x.shape[1] < dims else x for x in (rows, anchors))
    with np.errstate(over="ignore"):
        reach = np.sqrt((rows * rows).sum(1).max(initial=0.0)) * np.sqrt((anchors * anchors).sum(1).max(initial=0.0))
    if reach < 2**24 * 0.99:
        return (rows.astype(np.float32) @ anchors.T.astype(np.float32)).astype(np.int64)
    if reach < 2**53 * 0.99:
        return (rows @ anchors.T).astype(np.int64)
    whole = [[int(x) for x in r] for r in rows], [[int(x) for x in a] for a in anchors]
    exact = [[max(-_LONG - 1, min(_LONG, sum(x * y for x, y in zip(r, a)))) for a in whole[1]] for r in whole[0]]
    return np.array(exact, np.int64).reshape(len(rows), len(anchors))


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(scores) > 8 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:n]]
    return np.lexsort((ids, -scores))[:n]


class Best:
    """The first ``n`` rows within a range of scores that one search has met."""

    __slots__ = ("n", "low", "high", "scores", "ids")

    def __init__(self, n: int, low: int, high: int):
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def needs(self) -> int:
        """The least score that can still count."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.n else self.low

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.needs()) & (scores <= self.high))
        if len(good):
            scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
            first = _first(scores, ids, self.n)
            self.scores, self.ids = scores[first], ids[first]


def search(bucket: Bucket, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, wanted: list[list[Best]], same: bool) -> None:
    """Let the searches ``wanted`` of each anchor take what they need from a bucket: rows of its own label, or of others."""
    lengths = np.array([_length(v) for v in vectors])
    directions = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    focus = np.argsort(-np.abs(directions), 1, kind="stable")[:, :FOCUS]
    for part in bucket.parts():
        most, dims = float(part.lengths.max(initial=0.0)), part.rows.shape[1]
        whole, some = [], []
        for a in range(len(ids)):
            if not wanted[a]:
                continue
            need = min(b.needs() for b in wanted[a])
            reach = float(lengths[a]) * most
            if need > reach * (1 + 1e-9):
                continue
            cosine = need / reach * (1 - 1e-9) if reach > 0 else 0.0
            found = part.candidates(directions[a], min(1.0, cosine), focus[a][focus[a] < dims])
            if found is None:
                whole.append(a)
            elif len(found):
                some.append((a, found))
        scored = [(a, None, s) for a, s in zip(whole, products(part.rows, vectors[whole]).T)] if whole else []
        scored += [(a, found, products(part.rows[found], vectors[a : a + 1])[:, 0]) for a, found in some]
        for a, found, scores in scored:
            row_ids, row_labels = (part.ids, part.labels) if found is None else (part.ids[found], part.labels[found])
            fits = (row_labels == labels[a]) & (row_ids != ids[a]) if same else row_labels != labels[a]
            scores, row_ids = scores[fits], row_ids[fits]
            for best in wanted[a]:
                best.take(scores, row_ids)


# -- anchors in blocks -----------------------------------------------------------------


def anchors_of(packed: DataFrame, every: int) -> DataFrame:
    """(anchor, anchor_id, label, vector) of rows whose id is divisible; ``anchor`` tells rows with one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, n, dims, ids, labels, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                bucket = Bucket(dims, ids, labels, vectors)
                at = np.flatnonzero(bucket.ids % every == 0)
                cells = [pa.array([f"{key}:{i}" for i in at], pa.string()), pa.array(bucket.ids[at]), pa.array(bucket.labels[at]),
                         pa.array([bucket.rows[i].tobytes() for i in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, ["anchor", "anchor_id", "label", "vector"])

    return map_batches(packed, run, "anchor string, anchor_id long, label long, vector binary")


def _meet(anchors: DataFrame, packed: DataFrame, run, schema: str) -> DataFrame:
    """Anchors, in blocks, beside every bucket, through ``run``. ``anchors`` may have columns after the first four."""
    width = F.coalesce(F.max(F.octet_length("vector")), F.lit(0)).alias("width")
    n, width = anchors.agg(F.count(F.lit(1)), width).first()
    blocks = max(1, -(-n * max(8, width) // BLOCK))
    n_buckets = max(1, packed.count())
    cells = F.struct(*anchors.columns)
    block = anchors.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block")).agg(F.collect_list(cells).alias("anchors"))
    # A row of every bucket's number for every block, by an equi-join of both with the numbers of the blocks.
    places = packed.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1).cast("long"))).alias("block"))
    sent = places.join(block, "block").repartition(n_buckets, "bucket")
    both = sent.join(packed.repartition(n_buckets, "bucket"), "bucket")
    return map_batches(both.select("dims", "ids", "labels", "vectors", "anchors"), run, schema)


def _arrays(anchors: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    dims = max(len(a["vector"]) for a in anchors)
    vectors = np.frombuffer(b"".join(a["vector"].ljust(dims, b"\0") for a in anchors), "<f8").reshape(len(anchors), dims // 8)
    return np.array([a["anchor_id"] for a in anchors]), np.array([a["label"] for a in anchors]), vectors


def positives(anchors: DataFrame, packed: DataFrame, n: int = POSITIVES) -> DataFrame:
    """(anchor, place, positive_id, positive_score): the first rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *bucket, block in zip(*batch.columns):
                block = block.as_py()
                wanted = [[Best(n, -_LONG - 1, _LONG)] for _ in block]
                search(Bucket(*(c.as_py() for c in bucket)), *_arrays(block), wanted, True)
                out = [(a["anchor"], int(i), int(s)) for a, (b,) in zip(block, wanted) for i, s in zip(b.ids, b.scores)]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("anchor", "positive_id", "positive_score"), row)) for row in out],
                    pa.schema([("anchor", pa.string()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]),
                )

    found = _meet(anchors, packed, run, "anchor string, positive_id long, positive_score long")
    first = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= n)


def negatives(anchors: DataFrame, packed: DataFrame, found: DataFrame, n: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for pairs of `positives`."""
    pairs = found.groupBy("anchor").agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("pairs"))
    with_pairs = anchors.join(pairs, "anchor").select(*anchors.columns, "pairs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), *[pa.int64()] * 6]
        for batch in batches:
            for *bucket, block in zip(*batch.columns):
                block, out = block.as_py(), []
                wanted = [[Best(n, -(-least * p["positive_score"] // 100), p["positive_score"]) for p in a["pairs"]] for a in block]
                # A range that ends before it begins has no rows.
                live = [[b for b in bests if b.low <= b.high] for bests in wanted]
                search(Bucket(*(c.as_py() for c in bucket)), *_arrays(block), live, False)
                for a, bests in zip(block, wanted):
                    for p, b in zip(a["pairs"], bests):
                        same = a["anchor"], a["anchor_id"], p["place"], p["positive_id"], p["positive_score"]
                        out += [(*same, int(i), int(s)) for i, s in zip(b.ids, b.scores)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)],
                    ["anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"],
                )

    schema = "anchor string, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    some = _meet(with_pairs, packed, run, schema)
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = some.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(rows: DataFrame, every: int = ANCHORS) -> DataFrame:
    """Hard negatives of (vec_id, label, embedding) for every anchor and positive."""
    packed = buckets(quantised(rows))
    anchors = written(anchors_of(packed, every), "anchors")
    found = written(positives(anchors, packed), "positives")
    return negatives(anchors, packed, found)


#: What the query says, in SQL: every anchor against all rows.
OP11_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM (SELECT * FROM kept WHERE vec_id % 100 = 0) a JOIN kept b ON a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `embeddings`."""
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
