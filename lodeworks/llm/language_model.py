"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

Tokens are words in lower case (A-Z) and an end after each text. The model predicts one of a number of events
from the two events before it: a frequent word or the end is an event of its own, every other word belongs to
the event that the hash of its last letters names, and has its smoothed share of that event's training tokens,
one unseen word included. The number of events follows the corpus (`events_of`), and half of them are words.
An event's score is its bias plus the product of its vector with the sum of a vector per context place;
matrix products over all pairs of context events give the normalising sums, so the probabilities of all words
after a context sum to one.

Training covers every training text. Texts are dealt to parts of some ``PART`` tokens by a hash of id and text,
so neither files nor cores decide what is learnt. The first part makes the start; from there each part runs
noise-contrastive estimation in numpy in a task of its own, and the parameters are averaged, weighted by their
tokens, in Spark. Counts cover all training texts too. The ``KNOWN`` most frequent words at most are sent to
all tasks with their counts; occurrences of others are joined to the counts by a shuffle.

Edge cases: a null or empty text is its end alone; without training texts every token is unknown and scores
are zero; repeated rows get equal scores; a null id isn't held out; very long texts are read whole and very
long words are words like others; an empty table gives an empty result; only id and text are read, so other
columns may have any name.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.frames import documents, map_batches, remainder, text_of, written

#: Events of a corpus of 2^21 tokens; size of a vector; words sent to all tasks at most.
EVENTS, SIZE, KNOWN = 1024, 16, 200_000
SUFFIX = 3
#: Training: tokens of a part, noise samples of a step, tokens shuffled together, step size. A step has a token an event.
PART, NOISE, MIXED, RATE = 1 << 22, 48, 1 << 17, 0.06
#: Distinct words a task counts before it passes them on.
COUNTED = 400_000
END = b""


def events_of(total: int) -> int:
    """The events of a corpus, in 64s: as the sixth root of its tokens, as the normalising sums are a table of their square."""
    return 64 * max(2, round(EVENTS / 64 * (total / (1 << 21)) ** (1 / 6)))


def tokens(text: bytes) -> list[bytes]:
    """The words of a whole text, and its end."""
    return [*text.lower().split(), END]


def class_of(word: bytes, events: int) -> int:
    """The event of a word that is none of its own, among the latter half."""
    return events - events // 2 + zlib.crc32(word[-SUFFIX:]) % (events // 2)


def _class_column(events: int):
    """`class_of` for the column ``word``."""
    return (F.crc32(F.substring("word", -SUFFIX, SUFFIX)) % (events // 2) + (events - events // 2)).cast("int")


@dataclass
class Vocabulary:
    """Frequent words with their events and counts, and the totals of all."""

    words: dict[bytes, int]
    event: np.ndarray
    count: np.ndarray
    total: int
    distinct: int
    event_tokens: np.ndarray
    event_words: np.ndarray

    @property
    def wide(self) -> int:
        """The number of events; also the event before a text."""
        return len(self.event_tokens)

    def events(self, found: list[bytes]) -> np.ndarray:
        get, event = self.words.get, self.event
        at = [get(w, -1) for w in found]
        out = event[at]  # the last row, of unknown words, is a placeholder
        for i in np.flatnonzero(out < 0).tolist():
            out[i] = class_of(found[i], self.wide)
        return out


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n): occurrences over all of (body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = list(seen)
            columns = [pa.array(words, pa.binary()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                seen.update(tokens(text.as_py()))
                if len(seen) >= COUNTED:
                    yield out()
        yield out()

    found = map_batches(texts.select("body"), run, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """What tasks need to know of the counts: rows up to ``KNOWN``, and totals by event."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    events = events_of(total)
    alone = events - events // 2 - 1  # the end is one too
    first = counts.filter(F.octet_length("word") > 0).orderBy(F.col("n").desc(), "word").limit(alone).collect()
    own = {END: 0} | {bytes(r["word"]): i + 1 for i, r in enumerate(first)}
    # Counts by sixteenths of powers of two: the lowest such step above which there are KNOWN words at most.
    step = F.floor(F.log2("n") * 16).cast("int")
    left, lowest = KNOWN, 1 << 30
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.col("step").desc()).collect():
        left -= r["count"]
        if left < 0:
            break
        lowest = r["step"]
    known = counts.filter(step >= lowest).select("word", "n").collect()
    words = {bytes(r["word"]): i for i, r in enumerate(known)}
    many = {bytes(r["word"]): r["n"] for r in first} | {bytes(r["word"]): r["n"] for r in known}
    for word in own:
        words.setdefault(word, len(words))
    if END not in many:
        many[END] = (counts.filter(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first())[0]
    event = np.full(len(words) + 1, -1, np.int32)
    count = np.zeros(len(words) + 1, np.int64)
    for word, at in words.items():
        event[at], count[at] = own.get(word, -1), many[word]
        if event[at] < 0:
            event[at] = class_of(word, events)
    event_tokens, event_words = np.zeros(events, np.int64), np.zeros(events, np.int64)
    for r in counts.groupBy(_class_column(events).alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("w")).collect():
        event_tokens[r["class"]], event_words[r["class"]] = r["n"], r["w"]
    for word, at in own.items():
        event_tokens[class_of(word, events)] -= many[word]
        event_words[class_of(word, events)] -= many[word] > 0
        event_tokens[at], event_words[at] = many[word], 1
    return Vocabulary(words, event, count, int(total), int(distinct), event_tokens, event_words)


class Model:
    """Vectors by event and context place, and biases; all of them one flat array."""

    def __init__(self, flat: np.ndarray, events: int):
        self.flat, self.events = flat.astype(np.float32), events
        wide = (events + 1) * SIZE
        self.near = self.flat[:wide].reshape(events + 1, SIZE)
        self.far = self.flat[wide : 2 * wide].reshape(events + 1, SIZE)
        self.out = self.flat[2 * wide : 2 * wide + events * SIZE].reshape(events, SIZE)
        self.bias = self.flat[2 * wide + events * SIZE :]

    @classmethod
    def start(cls, shares: np.ndarray) -> Model:
        size = 2 * (len(shares) + 1) * SIZE + len(shares) * SIZE
        return cls(np.concatenate([np.random.default_rng(7).normal(0, 0.1, size), np.log(shares)]), len(shares))

    def train(self, triples: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], shares: np.ndarray, seed: int) -> int:
        """One pass of noise-contrastive estimation over blocks of (before that, before, event); tokens seen."""
        random = np.random.default_rng(seed)
        edges, offset = np.cumsum(shares), np.log(NOISE * shares).astype(np.float32)
        squares = np.full(len(self.flat), 1e-6, np.float32)
        slope = Model(np.zeros(len(self.flat)), self.events)
        seen = 0
        for block in triples:
            order = random.permutation(len(block[0]))
            for at in range(0, len(order), self.events):
                far, near, event = (x[order[at : at + self.events]] for x in block)
                noise = np.minimum(np.searchsorted(edges, random.random(NOISE)), self.events - 1)
                mixed = self.far[far] + self.near[near]
                right, wrong = self.out[event], self.out[noise]
                hit = 1 / (1 + np.exp(np.einsum("ij,ij->i", mixed, right) + self.bias[event] - offset[event]))
                miss = -1 / (1 + np.exp(-(mixed @ wrong.T + self.bias[noise] - offset[noise])))
                back = hit[:, None] * right + miss @ wrong
                slope.flat[:] = 0
                _scatter(slope.far, far, back)
                _scatter(slope.near, near, back)
                _scatter(slope.out, event, hit[:, None] * mixed)
                np.add.at(slope.out, noise, miss.T @ mixed)
                slope.bias += np.bincount(event, hit, self.events).astype(np.float32)
                np.add.at(slope.bias, noise, miss.sum(0))
                slope.flat /= len(far)
                squares += slope.flat**2
                self.flat += RATE * slope.flat / np.sqrt(squares)
            seen += len(order)
        return seen

    def sums(self) -> np.ndarray:
        """The log sums that normalise each pair of contexts, by the far and the near one."""
        near, far = self.near @ self.out.T + self.bias, self.far @ self.out.T
        sums = np.empty((self.events + 1, self.events + 1), np.float32)
        grown = np.exp(near - near.max(1, keepdims=True))
        for at in range(0, self.events + 1, 64):
            part = far[at : at + 64]
            most = part.max(1, keepdims=True)
            sums[at : at + 64] = np.log(np.exp(part - most) @ grown.T) + most + near.max(1)
        return sums

    def scores(self, far: np.ndarray, near: np.ndarray, event: np.ndarray) -> np.ndarray:
        """The scores of events after pairs of contexts, not normalised."""
        return np.einsum("ij,ij->i", self.far[far] + self.near[near], self.out[event]) + self.bias[event]


def _scatter(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add each of ``values`` to its row."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else rows
    into[rows[first]] += np.add.reduceat(values[order], first, axis=0)


def contexts(events: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before that, before, event) for the events of one text; ``start`` stands before it."""
    padded = np.concatenate([[start, start], events]).astype(np.int32)
    return padded[:-2], padded[1:-1], padded[2:]


def train(texts: DataFrame, words: Vocabulary, part: int = PART) -> Model:
    """A model of all texts of (id, body), by parts of some ``part`` tokens."""
    spark = texts.sparkSession
    shares = (words.event_tokens + 0.5) / (words.event_tokens + 0.5).sum()
    shared = spark.sparkContext.broadcast(words)
    parts = max(1, -(-words.total // part))
    dealt = texts.select("body", F.xxhash64("id", "body").alias("key"))
    # By their hash, so that texts come to a part, and in it, in one order, wherever they were read from.
    place = F.pmod(F.col("key"), F.lit(parts)).cast("int")
    first = dealt.filter(place == 0).repartition(1) if parts > 1 else dealt.repartition(1)
    model = _averaged(first.sortWithinPartitions("key"), shared, Model.start(shares), shares, 0)
    return _averaged(dealt.repartitionById(parts, place).sortWithinPartitions("key"), shared, model, shares, 1)


def _averaged(texts: DataFrame, shared, model: Model, shares: np.ndarray, round_: int) -> Model:
    """What tasks make of ``model``, each of its own partition, averaged by tokens."""
    start = texts.sparkSession.sparkContext.broadcast((model.flat, model.events))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, events = start.value
        vocabulary, own = shared.value, Model(flat.copy(), events)

        def blocks():
            held, size = [], 0
            for batch in batches:
                for text in batch.column(0):
                    found = contexts(vocabulary.events(tokens(text.as_py())), events)
                    held.append(found)
                    size += len(found[0])
                    if size >= MIXED:
                        yield tuple(np.concatenate(x) for x in zip(*held))
                        held, size = [], 0
            if held:
                yield tuple(np.concatenate(x) for x in zip(*held))

        seen = own.train(blocks(), shares, 1_000_000 * round_ + TaskContext.get().partitionId())
        place = pa.array(np.arange(-1, len(own.flat), dtype=np.int32))
        value = pa.array(np.concatenate([[seen], own.flat * float(seen)]))
        if seen:
            yield pa.RecordBatch.from_arrays([place, value], ["place", "value"])

    found = map_batches(texts.select("body"), run, "place int, value double")
    found = found.groupBy("place").agg(F.sum("value").alias("value")).collect()  # a row per parameter
    sums = np.zeros(len(model.flat) + 1)
    for r in found:
        sums[r["place"] + 1] = r["value"]
    return Model(sums[1:] / sums[0], model.events) if sums[0] else model


def scored(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """id, n_tokens, n_known, base_score and score of every row of (id, body)."""
    spark = docs.sparkSession
    plain = words.total + words.distinct + 1
    log_plain, log_event = float(np.log10(plain)), np.log10(words.event_tokens + words.event_words + 1.0)
    single = np.zeros(words.wide, bool)
    single[: words.wide - words.wide // 2] = True
    shared = spark.sparkContext.broadcast((words, model.flat, model.sums()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, flat, sums = shared.value
        wide, learnt = vocabulary.wide, Model(flat, vocabulary.wide)
        grown = np.log10(vocabulary.count + 1.0)
        # A known word's log10 share of its event.
        part = np.where(single[vocabulary.event], 0.0, grown - log_event[vocabulary.event])
        part[-1] = 0.0
        known = vocabulary.count > 0
        row, get = TaskContext.get().partitionId() << 36, vocabulary.words.get
        names = ["row", "id", "word", "class", "times", "n_tokens", "n_known", "base_score", "score"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = tokens(text.as_py())
                at = np.array([get(w, -1) for w in found])
                event = vocabulary.event[at]
                rare = np.flatnonzero(at < 0).tolist()
                for i in rare:
                    event[i] = class_of(found[i], wide)
                before, last, event = contexts(event, wide)
                chance = learnt.scores(before, last, event) - sums[before, last]
                score = float(chance.sum(dtype=np.float64)) / np.log(10) + float(part[at].sum())
                base = float(grown[at[at >= 0]].sum()) - (len(found) - len(rare)) * log_plain
                others = Counter(found[i] for i in rare)
                many = len(others)
                out[0] += [row] * (many + 1)
                out[1] += [doc_id] * (many + 1)
                out[2] += [None, *others]
                out[3] += [None, *(class_of(w, wide) for w in others)]
                out[4] += [None, *others.values()]
                for i, value in enumerate((len(found), int(known[at[at >= 0]].sum()), base, score), 5):
                    out[i] += [value, *[None] * many]
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, _kinds)], names)

    schema = (
        "row long, id long, word binary, class int, times long, n_tokens long, n_known long, base_score double, "
        "score double"
    )
    parts = written(map_batches(docs.select("id", "body"), run, schema), "parts")
    # A row per class.
    logs = F.array(*[F.lit(float(x)) for x in log_event])
    others = parts.filter("word IS NOT NULL").select("row", "id", "word", "class", "times")
    others = others.join(counts.select(F.col("word").alias("counted"), "n"), F.col("word") == F.col("counted"), "left")
    grown = F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0))
    others = others.select(
        "row", "id", F.lit(None).cast("long").alias("n_tokens"),
        F.when(F.col("n").isNotNull(), F.col("times")).alias("n_known"),
        (F.col("times") * (grown - log_plain)).alias("base_score"),
        (F.col("times") * (grown - F.get(logs, F.col("class")))).alias("score"),
    )
    whole = parts.filter("word IS NULL").select("row", "id", "n_tokens", "n_known", "base_score", "score")
    return whole.unionByName(others).groupBy("row", "id").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    ).drop("row")


_kinds = [
    pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()
]


def held_out(column: str):
    return F.coalesce(remainder(column, 7) == 2, F.lit(False))


def op8_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, scored by what the rows that aren't held out teach."""
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").cast("long").alias("id"), text_of().cast("binary").alias("body")
    )
    texts = docs.filter(~held_out("id"))
    counts = written(count_words(texts), "counts")
    words = vocabulary(counts)
    model = train(texts, words)
    return scored(docs, counts, words, model).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "n_tokens", "n_known",
        F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
