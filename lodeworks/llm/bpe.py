"""Byte-level BPE by a rank queue with a hierarchical bitmap.

The tokens of a pre-token are a linked list of positions. A queue has a bucket per merge rank, holding the
positions where a pair of that rank begins; a bitmap over the ranks in three levels finds the lowest rank
that has a bucket by find-first-set. Merging a pair changes only its neighbours, which enter their new
buckets; what they leave behind is stale and skipped when it comes up. So a pre-token of n bytes takes
O(n log n), where scanning for the lowest pair after each merge takes O(n^2).

Every pre-token, of whatever length, goes this way. The results of short ones are kept for the next time
they occur, in a table of bounded size that all tasks of a Python worker share.

Edge cases: a null text counts as empty and has no tokens; very long texts and pre-tokens are encoded
whole; repeated rows give repeated results; an empty table gives an empty result; other columns of the
input are not read by the encoder, whatever their names.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.frames import documents, map_batches, text_of

#: Pre-tokens and runs of them that one Python worker keeps, twice, as it forgets the half that it has met before the
#: other; the longest that it keeps; and pairs with their ranks.
KEPT, LONGEST, PAIRS = 350_000, 64, 200_000

#: White space as patterns of tokenizers mean it: Unicode's White_Space.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Text between blanks, with a space before it. Patterns that take at most one space before a token, and leave
#: the last blank of a run to what follows, never have a token that crosses these bounds; PATTERN is one.
CHUNK = rf" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"


class RankQueue:
    """Positions by rank; the lowest rank first, inside a rank the leftmost position first.

    Three levels of bits over the buckets: a word has a bit per rank, a group one per word, the top one per group. Words
    are of 32 bits, as Python is quicker with small integers.
    Empty again after use, so that one serves every pre-token. `Encoder.merge` works on its parts, with the top
    level in a variable of its own: a call for each push and pop would cost as much as what it does.
    """

    __slots__ = ("buckets", "words", "groups")

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.words = [0] * ((ranks >> 5) + 1)
        self.groups = [0] * ((ranks >> 10) + 1)


class Encoder:
    """Encodes and decodes by a file of base64 tokens and ranks; an id is its token's rank."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self._bytes = [self.ranks[bytes([b])] for b in range(256)]
        self._queue = RankQueue(len(self.tokens))
        #: The rank of each two bytes, -1 without one, and of pairs of tokens that came up.
        self._first = [self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self._pairs: dict[int, int] = {}
        self._runs = re.compile(CHUNK).findall
        self._split = regex.compile(pattern).findall
        self._kept: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _rank(self, key: int) -> int:
        """The rank of a pair that isn't kept yet, -1 without one."""
        rank = self.ranks.get(self.tokens[key >> 32] + self.tokens[key & 0xFFFFFFFF], -1)
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        self._pairs[key] = rank
        return rank

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids = list(map(self._bytes.__getitem__, piece))
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets, words, groups = self._queue.buckets, self._queue.words, self._queue.groups
        known, rank_of, first, top, at = self._pairs.get, self._rank, self._first, 0, 0
        # The rank of the pair that begins at each position, -1 without one.
        ranks = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        # Every pair of bytes goes to the end of its bucket: positions rise.
        for rank in ranks:
            if rank >= 0:
                bucket = buckets[rank]
                if not bucket:
                    word = words[at_word := rank >> 5]
                    words[at_word] = word | 1 << (rank & 31)
                    if not word:
                        groups[rank >> 10] |= 1 << (at_word & 31)
                        top |= 1 << (rank >> 10)
                bucket.append(at)
            at += 1
        while top:
            # Find-first-set on every level gives the lowest rank that has positions.
            group = (top & -top).bit_length() - 1
            bits = groups[group]
            at_word = group << 5 | (bits & -bits).bit_length() - 1
            word = words[at_word]
            rank = at_word << 5 | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket.pop()
                words[at_word] = word = word & (word - 1)
                if not word:
                    groups[group] = bits = bits & (bits - 1)
                    if not bits:
                        top &= top - 1
            # Stale: the position was merged away, or what begins there now is another pair.
            if ranks[at] != rank:
                continue
            right = after[at]
            ids[at], ids[right] = rank, -1
            following = after[right]
            left = before[at]
            if following >= n:
                ranks[at] = -1
                after[at] = n
            else:
                ranks[right] = -1
                after[at] = following
                before[following] = at
                new = known(key := rank << 32 | ids[following])
                if new is None:
                    new = rank_of(key)
                ranks[at] = new
                if new >= 0:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, at)
                    else:
                        bucket.append(at)
                        word = words[at_word := new >> 5]
                        words[at_word] = word | 1 << (new & 31)
                        if not word:
                            groups[new >> 10] |= 1 << (at_word & 31)
                            top |= 1 << (new >> 10)
            if left >= 0:
                new = known(key := ids[left] << 32 | rank)
                if new is None:
                    new = rank_of(key)
                ranks[left] = new
                if new >= 0:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, left)
                    else:
                        bucket.append(left)
                        word = words[at_word := new >> 5]
                        words[at_word] = word | 1 << (new & 31)
                        if not word:
                            groups[new >> 10] |= 1 << (at_word & 31)
                            top |= 1 << (new >> 10)
        return [i for i in ids if i >= 0]

    def _new(self, run: str) -> bytes:
        """Ids of a run of text, or of a pre-token inside one, that isn't among the newest kept."""
        packed = self._older.get(run)
        if packed is not None:
            self._kept[run] = packed
            return packed
        pieces = self._split(run)
        if len(pieces) == 1:
            ids = self.merge(run.encode("utf-8", "surrogatepass"))
            packed = pack(f"<{len(ids)}I", *ids)
        else:
            packed = b"".join([self._kept.get(piece) or self._new(piece) for piece in pieces])
        if len(run) <= LONGEST:
            if len(self._kept) >= KEPT:
                self._older, self._kept = self._kept, {}
            self._kept[run] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        known, new = self._kept.get, self._new
        return b"".join([known(run) or new(run) for run in self._runs(text)])

    def decode(self, packed: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


_open: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file, opened once per Python worker."""
    if (path, pattern) not in _open:
        _open[path, pattern] = Encoder(path, pattern)
    return _open[path, pattern]


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Rank file and pattern of a public tokenizer, installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, packed as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = pa.array([bpe.encode(t.as_py()) for t in part.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    return map_batches(slim, run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, body): the bytes of every row of (doc_id, ids), put together from its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                body = pa.array([bpe.decode(x.as_py()) for x in part.column(1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, body], ["doc_id", "ids", "body"])

    return map_batches(encoded, run, "doc_id long, ids binary, body binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, body): `encode` and `decode` in one pass, so that a task needs one Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [bpe.encode(t.as_py()) for t in part.column(1)]
                body = pa.array([bpe.decode(x) for x in ids], pa.binary())
                columns = [part.column(0), pa.array(ids, pa.binary()), body]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "body"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    return map_batches(slim, run, "doc_id long, ids binary, body binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of what they decode to."""
    return round_trip(docs, path, pattern).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("body", 256).alias("decoded_sha256"),
    )


def op4_bpe_rank_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, encoded and decoded."""
    return digests(documents(spark, sf_dir), *vocabulary())
