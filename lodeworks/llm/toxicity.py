"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: density and mean weight of lexicon words, their number, the share of them with a
second-person pronoun close by, the share of them spelt in disguise, rates of disguised words, capitals,
punctuation and exclamation marks, and length. The lexicon is a short list of common insults, and the words
that toxic texts of the training sample surely hold more often than others.

Labels are read from at most ``SAMPLE`` labelled rows, those with the smallest hash of their id. The trees
grow on all of them; the calibration is fitted to margins that trees grown without a row give it. Only counts of words and rows of features
of the sample reach the driver. Scoring is one pass over the texts without a shuffle.

Edge cases: a null text counts as empty and gets the score of a text without words; a label of null is no
label, of several labels of an id the largest counts; without labels of both kinds every score is the
share of toxic labels (0 without any); repeated rows get equal scores; very long texts are read whole;
an empty table gives an empty result; other columns are never inputs and may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lodeworks.llm.frames import boxed, documents, map_batches, remainder, text_of, unboxed

#: Most labelled rows that are learned from.
SAMPLE = 20_000
#: Parts of the sample for the calibration.
FOLDS = 4
#: A learned word occurs in so many toxic texts at least, in this share of them, and, two standard errors
#: allowed for, so many times more often than in others.
LEAST_TEXTS, LEAST_SHARE, LEAST_RATIO, LEXICON = 4, 0.02, 3.0, 500
#: Boosting.
TREES, DEPTH, RATE, BINS, LEAST_WEIGHT = 80, 3, 0.2, 64, 0.3
#: Words between a lexicon word and a pronoun that still count as close.
NEAR = 5

#: Second-person pronouns of English, French, German and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen euch euer "
    "ti tus tuyo usted ustedes vosotros vuestro".split()
)
#: Common insults of the same languages, and the weight they have unless the sample says more.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb dumbass imbecile loser losers pathetic worthless disgusting scum trash "
    "clown jerk bastard bitch asshole retard retarded filth vermin pig freak ugly "
    "imbécile crétin débile connard connasse salaud salope ordure dummkopf arschloch trottel schwein abschaum "
    "idiota imbécil estúpido estúpida cabrón gilipollas basura escoria".split()
)
INSULT_WEIGHT = 2.0

#: Letters that digits and signs stand for in disguised words.
_PLAIN = str.maketrans("013457@$!|+", "oieastasilt")

_words = re.compile(r"[^\W\d_]+").findall
_disguised = re.compile(r"\b[^\W\d_]+(?:[0-9@$!|+*.\-_][^\W\d_]+)+|\b[^\W\d_]*[0-9@$!|+][^\W\d_]+").findall
_ALL = bytes(range(256))


def _all_but(keep: bytes) -> bytes:
    return bytes(b for b in _ALL if b not in keep)


_CAPITALS = _all_but(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SIGNS = _all_but(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_CRIES = _all_but(b"!")


def words_of(text: str) -> list[str]:
    return _words(text.lower())


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a whole text."""
    low = text.lower()
    words = _words(low)
    raw = text.encode("utf-8", "replace")
    n, size = max(1, len(words)), max(1, len(raw))
    hits = [i for i, w in enumerate(words) if w in lexicon]
    close = sum(1 for i in hits if not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]))
    masked = _disguised(low)
    plain = [re.sub(r"[^\w]|_", "", w.translate(_PLAIN)) for w in masked]
    hidden = [w for w in plain if w in lexicon]
    found = len(hits) + len(hidden)
    insults = sum(1 for i in hits if words[i] in INSULTS) + sum(1 for w in hidden if w in INSULTS)
    weight = sum(lexicon[words[i]] for i in hits) + sum(lexicon[w] for w in hidden)
    return [
        found / n, insults / n, weight / n, float(found), float(insults), weight, close / max(1, found), close / n, len(hidden) / max(1, found),
        len(masked) / n, len(raw.translate(None, _CAPITALS)) / size, len(raw.translate(None, _SIGNS)) / size,
        len(raw.translate(None, _CRIES)) / size, float(np.log1p(len(words))), size / n,
    ]


@dataclass
class Trees:
    """Boosted trees of equal depth for the logistic loss; a node's children are 2i+1 and 2i+2."""

    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to features and 0/1 labels, each by Newton steps on histograms of the features."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    model = Trees(base=float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = [np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)]
    margin = np.full(len(x), model.base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        for depth in range(DEPTH):
            first, many = 2**depth - 1, 2**depth
            best = np.full(many, 1e-9)
            place = np.zeros(many, np.int64)
            for f, (values, at) in enumerate(zip(binned, cuts)):
                wide = len(at) + 1
                key = (node - first) * wide + values
                g = np.bincount(key, slope, many * wide).reshape(many, wide)
                h = np.bincount(key, bend, many * wide).reshape(many, wide)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
                if gain.size:
                    at_best = gain.argmax(1)
                    top = gain[np.arange(many), at_best]
                    better = top > best
                    best[better], place[better] = top[better], at_best[better]
                    feature[first : first + many][better] = f
                    cut[first : first + many][better] = at[at_best[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - (2**DEPTH - 1)
        g, h = np.bincount(leaf, slope, 2**DEPTH), np.bincount(leaf, bend, 2**DEPTH)
        value = RATE * g / (h + 1)
        margin += value[leaf]
        model.feature.append(feature)
        model.cut.append(cut)
        model.leaf.append(value)
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing function from margin to share of ones that fits best (pooled neighbours)."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of y, number, lowest and highest margin
    for m, v in zip(margin[order].tolist(), y[order].tolist()):
        blocks.append([v, 1, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    at = [m for b in blocks for m in b[2:]]
    return np.array(at), np.array([b[0] / b[1] for b in blocks for _ in range(2)])


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    share: float

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.share)
        x = np.array([features(t, self.lexicon) for t in texts])
        margin = self.trees.margin(x)
        if not len(self.knots[0]):
            return 1 / (1 + np.exp(-margin))
        return np.interp(margin, *self.knots)


def _lexicon(sample: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = list(set(words_of(text.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array([label] * len(words), pa.int32())], ["word", "toxic"]
                )

    found = map_batches(sample.select("body", "toxic"), run, "word string, toxic int").groupBy("word")
    found = found.agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
    found = found.withColumn(
        "weight", F.log((F.col("bad") + 0.5) / (toxic + 1) / ((F.col("all") - F.col("bad") + 0.5) / (clean + 1)))
    )
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("all") - F.col("bad") + 0.5))
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    found = found.filter((F.col("bad") >= least) & (F.col("weight") - 2 * error >= float(np.log(LEAST_RATIO))))
    rows = found.orderBy(F.col("weight").desc(), "word").limit(LEXICON).collect()
    return dict.fromkeys(INSULTS, INSULT_WEIGHT) | {r["word"]: r["weight"] for r in rows}


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labels (doc_id, toxic) and the texts they belong to; ids held out are for the caller to drop."""
    slim = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    slim = slim.filter("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = slim.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    spark = docs.sparkSession
    chosen = spark.createDataFrame([tuple(r) for r in chosen], "id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("body"))
    sample = texts.join(F.broadcast(chosen), "id")  # SAMPLE rows at most
    counts = sample.agg(F.count("*"), F.sum("toxic")).first()
    many, toxic = counts[0], counts[1] or 0
    if not 0 < toxic < many:
        return Model({}, None, (np.zeros(0), np.zeros(0)), toxic / many if many else 0.0)
    lexicon = _lexicon(sample, toxic, many - toxic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), lexicon) for t in batch.column(2)]
            x = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], x], ["id", "toxic", "x"])

    rows = map_batches(sample.select("id", "toxic", "body"), run, "id long, toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r["id"], r["x"]))
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    part, margin = np.zeros(len(y), np.int64), np.zeros(len(y))
    for label in (0, 1):  # each part has its share of both kinds
        at = np.flatnonzero(y == label)
        part[at] = np.arange(len(at)) % FOLDS
    for fold in range(FOLDS):
        margin[part == fold] = grow(x[part != fold], y[part != fold]).margin(x[part == fold])
    return Model(lexicon, grow(x, y), isotonic(margin, y), toxic / many)


def scored(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """The named columns of ``docs``, and __score."""
    found = _scored(docs, model)
    return found.select(*[F.col("row").getField(c).alias(c) for c in columns], F.col("score").alias("__score"))


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score): the rows of ``docs``, each as one column, and their scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                score = pa.array(model.score([t or "" for t in part.column(0).to_pylist()]), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(1), score], ["row", "score"])

    slim = docs.select("text", boxed(docs))
    return map_batches(slim, run, StructType([slim.schema["row"], StructField("score", DoubleType())]))


def held_out(column: str = "doc_id"):
    return remainder(column, 5) == 0


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with the columns of ``docs``."""
    return unboxed(_scored(docs, model).filter("score < 0.5"), docs.columns)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, scored by what the labels outside the held-out fold teach."""
    docs = documents(spark, sf_dir)
    model = learn(docs, training_labels(spark, sf_dir))
    return scored(docs.select("doc_id", "text"), model, "doc_id").select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("__score").alias("score"),
        F.when(F.col("__score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
