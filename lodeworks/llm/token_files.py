"""Token-id files: shards of ids under a Re-Pair grammar, decodable from any place.

Documents are range-partitioned and sorted by id, encoded, ended with id 0 and gathered into shards of
whole documents. A shard's ids are compressed by Re-Pair: frequent pairs of neighbours are replaced by
nonterminals, again and again, until no pair has ``LEAST_USES`` places without overlap. A round
sorts the places that may count by their pair, takes the ``MOST`` most frequent pairs, settles overlaps from left
to right in favour of the more frequent, and replaces all at once; a rule is made only for a pair replaced at least
``LEAST_USES`` times. Once a round saves less than ``LEAST_GAIN`` of the sequence, rounds take all pairs. The places of a
round are those of frequent pairs in the round before, and those beside a new symbol: no other pair can be frequent.

The format is a Parquet table, a row per shard in order of ``shard``:

| column | content |
|-|-|
| shard | range partition * 2^24 + running number inside it; ascending with doc_id |
| n_tokens, first | ids in the shard, end ids included; the first nonterminal |
| doc_ids | doc_id of each document, 64-bit signed |
| doc_lengths | its number of ids, 64-bit unsigned |
| rules | the two symbols of each nonterminal, 32-bit unsigned; only earlier symbols occur in a rule |
| lengths | the number of ids that each nonterminal stands for, 32-bit unsigned |
| sequence | the symbols left, 32-bit unsigned |

All binary columns are little-endian. `Shard.ids` decodes any range: the running sum of expansion lengths
says which symbols hold it, and only those are expanded.

Edge cases: a null or empty text is its end id alone; a document longer than a shard makes a shard of its
own; documents that repeat an id follow each other; a null id sorts first and is kept as null in the
result; an empty table gives no shards and an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.bpe import CHUNK
from lodeworks.llm.frames import documents, map_batches, text_of
from lodeworks.storage import work_folder

#: Ids at which a shard is closed.
SHARD = 1 << 21
#: Pairs that a round takes.
MOST = 1 << 14
#: Uses of a rule, and share of the sequence that a round must save; below it rounds take all pairs.
LEAST_USES, LEAST_GAIN = 4, 0.01
END = 0
#: Runs of text kept by a Python worker, the longest that is kept in bytes, and ids at which all are forgotten.
KEPT, LONGEST, IDS = 1_400_000, 64, 8_000_000
#: New words that go through the model at a time, and bytes of text that are encoded at a time, and a text more.
WORDS, BLOCK = 32, 1 << 22
#: Texts whose runs aren't plain: three blanks or line ends together, two at the end, any other blank (as in `CHUNK`).
UNEVEN = (
    r"[ \n]{3}|[ \n]{2}$|"
    r"[\t\x0B-\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_NULL = -(1 << 63)

SCHEMA = (
    "shard long, n_tokens long, first int, doc_ids binary, doc_lengths binary, rules binary, lengths binary, "
    "sequence binary"
)


def repair(ids: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, lengths, sequence) of ids below ``first``."""
    sequence, rules, lengths = ids.astype(np.uint32), np.zeros((0, 2), np.uint32), np.ones(first, np.uint32)
    at, most = np.arange(max(len(sequence) - 1, 0)), MOST
    while len(at):
        kinds, counts, at, kind = _frequent(sequence, at, len(lengths))
        best, of = _chosen(at, kind, counts, most)
        if not len(best):
            break
        used = np.bincount(of, minlength=len(kinds)) > 0
        new, number = kinds[used], np.cumsum(used) - 1
        sequence[best] = len(lengths) + number[of]
        lengths = np.concatenate([lengths, lengths[new].sum(1, dtype=np.uint32)])
        rules = np.concatenate([rules, new])
        if len(best) - 2 * len(new) < LEAST_GAIN * len(sequence):
            most = len(sequence)
        sequence, at = _closed(sequence, kind >= 0 if at is None else at, best)
    return rules, lengths[first:], sequence


def _frequent(sequence: np.ndarray, at: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
    """(pairs, number of places, places, which pair is at each): the pairs with ``LEAST_USES`` places among ``at``, which stay ascending.

    If many places are left, they aren't listed (None): the last array has all of the sequence, -1 at the others.
    """
    bits, place_bits = np.uint64(symbols.bit_length()), np.uint64(len(sequence).bit_length())
    whole = len(at) == len(sequence) - 1
    keys = (sequence[:-1] if whole else sequence[at]).astype(np.uint64)
    keys <<= bits
    keys |= sequence[1:] if whole else sequence[at + 1]
    if 2 * int(bits) + int(place_bits) <= 64:  # pair and place are one number, which sorts fastest
        keys <<= place_bits
        keys |= at.view(np.uint64)
        keys.sort()
        at = (keys & np.uint64((1 << int(place_bits)) - 1)).view(np.int64)
        keys >>= place_bits
    else:
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
    begins = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=begins[1:])
    starts = np.flatnonzero(begins)
    counts = np.diff(starts, append=len(keys)).astype(np.int32 if place_bits < 32 else np.int64)
    often = counts >= LEAST_USES
    kinds = keys[starts[often]]
    kinds = np.stack([kinds >> bits, kinds & np.uint64((1 << int(bits)) - 1)], 1).astype(np.uint32)
    if 16 * counts[often].sum() > len(sequence):
        kind = np.full(len(sequence), -1, np.int32)
        kind[at] = np.repeat(np.where(often, np.cumsum(often) - 1, -1).astype(np.int32), counts)
        return kinds, counts[often], None, kind
    at, counts = at[np.repeat(often, counts)], counts[often]
    order = np.argsort(at)
    return kinds, counts, at[order], np.repeat(np.arange(len(kinds), dtype=np.int32), counts)[order]


def _chosen(at: np.ndarray | None, kind: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places to replace, of the ``most`` frequent pairs, and the pair at each; none only if no pair has enough without overlap."""
    n_kinds = len(counts)
    least = LEAST_USES if n_kinds <= most else np.partition(counts, n_kinds - most)[n_kinds - most]
    if at is None:
        weight = np.append(np.where(counts >= least, counts, 0), counts.dtype.type(0))[kind]
        stay = weight > 0
        stay[:-1] &= weight[:-1] >= weight[1:]
        stay[1:] &= weight[1:] >= weight[:-1]
        best = np.flatnonzero(stay)
        best = best[np.flatnonzero(_alternate(best))]
        of = kind[best]
    else:
        some = np.flatnonzero(counts[kind] >= least)
        some = some[_apart(at[some], counts[kind[some]])]
        best, of = at[some], kind[some]
    used = np.bincount(of, minlength=n_kinds) >= LEAST_USES
    if used.any():
        enough = np.flatnonzero(used[of])
        return best[enough], of[enough]
    if at is None:
        at = np.flatnonzero(kind >= 0)
        kind = kind[at]
    # Pairs block each other: one after the other, the more frequent first, at the places still free.
    order, ends = np.argsort(kind, kind="stable"), np.cumsum(counts)
    # free[i + 1] is place at[i]; a place is next to another in the list or to none.
    beside = np.concatenate([[False], at[1:] == at[:-1] + 1, [False]])
    taken, found = np.zeros(len(at) + 2, bool), []
    for k in np.argsort(-counts, kind="stable").tolist():
        places = order[ends[k] - counts[k] : ends[k]]
        blocked = taken[places + 1] | (taken[places] & beside[places]) | (taken[places + 2] & beside[places + 1])
        places = places[~blocked]
        places = places[_apart(at[places], np.ones(len(places), np.int64))]
        if len(places) >= LEAST_USES:
            taken[places + 1] = True
            found.append(places)
    some = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return at[some], kind[some]


def _closed(sequence: np.ndarray, at: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence without the second symbols of the pairs at ``best``, and the places that may count from now on; ``at``: places or a mask."""
    gone = best + 1
    # The symbol before a new one counts too; where that is gone, it was the end of another new one.
    if at.dtype == bool:
        left, may = np.ones(len(sequence), bool), np.append(at, False)  # the spare place is before the first
        left[gone] = False
        may[best] = may[best - 1] = True
        left = np.flatnonzero(left)  # places are several times as fast as a mask
        return sequence[left], np.flatnonzero(may[left[:-1]])
    sequence, at = np.delete(sequence, gone), np.unique(np.concatenate([at, best, best - 1]))
    before = np.searchsorted(gone, at)
    at = (at - before)[(at >= 0) & (gone[np.minimum(before, len(gone) - 1)] != at)]
    return sequence, at[at < len(sequence) - 1]


def _apart(at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which places of pairs to take without overlaps: the more frequent of two neighbours, of equals every second."""
    touching = at[1:] == at[:-1] + 1
    stay = np.ones(len(at), bool)
    stay[:-1] &= ~(touching & (counts[1:] > counts[:-1]))
    stay[1:] &= ~(touching & (counts[:-1] > counts[1:]))
    some = np.flatnonzero(stay)
    return some[_alternate(at[some])]


def _alternate(at: np.ndarray) -> np.ndarray:
    """Which places to take without overlaps: of places in a row every second, from the first."""
    take = np.ones(len(at), bool)
    take[1:] = at[1:] != at[:-1] + 1
    # Of the places that follow another one directly, every second.
    later = np.flatnonzero(~take)
    starts = np.ones(len(later), bool)
    starts[1:] = later[1:] != later[:-1] + 1
    order = np.arange(len(later))
    take[later[(order - np.maximum.accumulate(np.where(starts, order, 0))) % 2 == 1]] = True
    return take


class Shard:
    """One row of the files, ready to decode."""

    def __init__(self, first: int, rules: bytes, lengths: bytes, sequence: bytes):
        self._sequence = np.frombuffer(sequence, "<u4")
        rules, lengths = np.frombuffer(rules, "<u4").reshape(-1, 2), np.frombuffer(lengths, "<u4")
        self._length = np.concatenate([np.ones(first, np.int64), lengths.astype(np.int64)])
        self._start = np.concatenate([[0], np.cumsum(self._length)])
        self._flat = np.zeros(self._start[-1], np.uint32)
        self._flat[:first] = np.arange(first)
        done = 0
        while done < len(rules):
            # Rules up to the first that needs one of this same stretch.
            late = np.flatnonzero((rules[done:] >= first + done).any(1))
            stop = done + int(late[0]) if len(late) else len(rules)
            at = self._start[first + done]
            expanded = self._expand(rules[done:stop].reshape(-1))
            self._flat[at : at + len(expanded)] = expanded
            done = stop
        self._ends = np.cumsum(self._length[self._sequence])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths = self._length[symbols]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._start[symbols] - (ends - lengths), lengths)
        return self._flat[shift + np.arange(len(shift))]

    def __len__(self) -> int:
        return int(self._ends[-1]) if len(self._ends) else 0

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start..stop of the shard."""
        stop = len(self) if stop is None else min(stop, len(self))
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self._ends, [start, stop - 1], "right")
        skipped = int(self._ends[a - 1]) if a else 0
        return self._expand(self._sequence[a : b + 1])[start - skipped : stop - skipped]


class Encoder:
    """The tokenizer of a file of the tokenizers library, with the ids of recent runs of text kept.

    A text is encoded run by run, cut before blanks and between a letter and a mark, bounds that no token of a byte-level
    tokenizer crosses. Runs are slices of the text's own bytes, and Arrow finds the different ones. New words go to the
    library's model some at a time, spelt as the tokenizer spells bytes, with a letter between them that no longer token
    holds, so that none crosses it. Other new runs go through the whole tokenizer, and whole texts do if it has other steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer, models, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.first = self._tokenizer.get_vocab_size(with_added_tokens=True)
        cut, model, added = (
            self._tokenizer.pre_tokenizer, self._tokenizer.model, self._tokenizer.get_added_tokens_decoder().values()
        )
        tokens = self._tokenizer.get_vocab(with_added_tokens=False)
        longer = set("".join(token for token in tokens if len(token) > 1))
        #: Letters of bytes that are tokens and in no longer one, of control characters, which no word holds.
        apart = [code for code in _SPELT[:32].tolist() if chr(code) in tokens and chr(code) not in longer]
        self._usual = (
            self._tokenizer.normalizer is None and self._tokenizer.truncation is None and self._tokenizer.padding is None
            and isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space
            and isinstance(model, models.BPE) and not model.dropout and all(token.special for token in added)
            and bool(apart)
        )
        self._words = Tokenizer(model)
        if self._usual:
            self._apart, self._apart_id = apart[0], tokens[chr(apart[0])]
        self._runs = re.compile(CHUNK).findall
        self._forget()

    def _forget(self) -> None:
        #: The number of each run that is kept; the ids of run n are _ids[_starts[n] : _starts[n + 1]].
        self._kept: dict[bytes, int] = {}
        self._starts, self._ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, words: pa.Array, runs: list[bytes]) -> np.ndarray:
        """The numbers of runs that aren't kept yet; they are kept from now on, unless they are long."""
        data, ends = _bytes_of(words)
        letter = _after_letter(data)
        letter[:-1] |= (data[:-1] == 0xC3) & letter[1:]
        letter[ends[:-1]] |= data[ends[:-1]] == 32
        others = np.concatenate([[0], np.cumsum(~letter)])[ends]
        lengths = np.diff(ends)
        plain, long = (others[1:] == others[:-1]) & (lengths > 1), np.flatnonzero(lengths > LONGEST)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        n_plain, found, sizes = np.count_nonzero(plain), [], np.zeros(len(runs), np.int64)
        if n_plain:
            data, ends = _bytes_of(words.take(pa.array(order[:n_plain])))
            marked = np.insert(_SPELT[data], ends[:-1], self._apart)
            cuts = [*(ends[:-1] + np.arange(n_plain))[::WORDS].tolist(), len(marked)]
            some = [marked[a:b].tobytes().decode("utf-32-le") for a, b in zip(cuts, cuts[1:])]
            # The fast form leaves out offsets in the text, not tokens.
            encoded = self._words.encode_batch_fast(some, add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in encoded])
            begins = np.flatnonzero(ids == self._apart_id)
            sizes[:n_plain] = np.diff(begins, append=len(ids)) - 1
            found.append(np.delete(ids, begins))
        rest = [runs[i].decode() for i in order[n_plain:].tolist()]
        for i, encoding in enumerate(self._tokenizer.encode_batch_fast(rest, add_special_tokens=False), n_plain):
            found.append(np.array(encoding.ids, np.uint32))
            sizes[i] = len(encoding.ids)
        numbers = np.empty(len(runs), np.int64)
        numbers[order] = np.arange(len(self._starts) - 1, len(self._starts) - 1 + len(runs))
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(sizes)])
        self._ids = np.concatenate([self._ids, *found])
        self._kept.update(zip(runs, numbers.tolist()))
        for i in long.tolist():
            del self._kept[runs[i]]
        return numbers

    def _split(self, texts: pa.Array, even: bool) -> tuple[pa.Array, np.ndarray]:
        """(runs of all texts, how many end with each text); of even ones a blank begins a run and a line end is one."""
        if not even:
            split = [self._runs(t) for t in texts.to_pylist()]
            runs = pa.array([run.encode() for some in split for run in some], pa.large_binary())
            return runs, np.cumsum(list(map(len, split)), dtype=np.int64)
        data, ends = _bytes_of(texts)
        line, begins = data == 10, np.zeros(len(data) + 1, bool)
        begins[:-1] = line | (data == 32)
        begins[1:] |= line
        begins[1:-1] |= _after_letter(data)[:-1] & _marks(data)[1:]
        begins[ends] = True
        places = np.flatnonzero(begins)
        buffers = [None, pa.py_buffer(places), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers), np.searchsorted(places, ends[1:])

    def _encode(self, split: pa.Array, n_runs: np.ndarray) -> list[bytes]:
        coded = split.dictionary_encode()
        runs = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # ten times as fast as to_pylist
        number = np.fromiter(map(self._kept.get, runs, repeat(-1)), np.int64, len(runs))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn(coded.dictionary.take(pa.array(new)), [runs[i] for i in new.tolist()])
        starts, codes = self._starts[number], coded.indices.to_numpy()
        sizes = (self._starts[number + 1] - starts)[codes]
        ends = np.cumsum(sizes)
        ids = self._ids[np.repeat(starts[codes] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        packed, stops = ids.astype("<u4").tobytes(), (4 * np.concatenate([[0], ends])[n_runs]).tolist()
        if len(self._kept) > KEPT or len(self._ids) > IDS:
            self._forget()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """The ids of whole texts, as little-endian 32-bit integers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self._usual:
            found = self._tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in found]
        uneven, out = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False), [b""] * len(texts)
        for even, at in ((True, np.flatnonzero(~uneven)), (False, np.flatnonzero(uneven))):
            if len(at):
                for i, ids in zip(at.tolist(), self._encode(*self._split(texts.take(pa.array(at)), even))):
                    out[i] = ids
        return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends), without a copy of the bytes."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends.astype(np.int64) - ends[0]


def _after_letter(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 end a letter, of those up to U+00FF; from U+00C0 all but two are letters, and begin with C3."""
    ends = (data | 32) - 97 < 26  # bytes below wrap around
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    ends[second] = (data[second] != 0x97) & (data[second] != 0xB7)
    return ends


def _marks(data: np.ndarray) -> np.ndarray:
    """Which bytes are ASCII but no letter, digit, blank or control character."""
    return (data - 33 < 94) & ((data | 32) - 97 >= 26) & (data - 48 >= 10)


#: The letter with which a byte-level tokenizer spells each byte: printable Latin-1 itself, others from U+0100 on.
_shown = np.array([chr(b).isprintable() and b not in (0x20, 0xA0) for b in range(256)])
_SPELT = np.where(_shown, np.arange(256), 255 + np.cumsum(~_shown)).astype("<u4")

_open: dict[str, Encoder] = {}


def shards(docs: DataFrame, path: str) -> DataFrame:
    """Rows of the files for all of ``docs``, by the tokenizer at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _open:
            _open[path] = Encoder(path)
        encoder = _open[path]
        number = TaskContext.get().partitionId() << 24
        end = np.array([END], "<u4").tobytes()
        doc_ids: list[int] = []
        parts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number, size
            ids = np.frombuffer(b"".join(parts), "<u4")
            rules, lengths, sequence = repair(ids, encoder.first)
            row = {
                "shard": number, "n_tokens": len(ids), "first": encoder.first,
                "doc_ids": np.array(doc_ids, "<i8").tobytes(),
                "doc_lengths": np.array([len(p) // 4 for p in parts], "<u8").tobytes(),
                "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
                "sequence": sequence.astype("<u4").tobytes(),
            }
            number, size = number + 1, 0
            doc_ids.clear()
            parts.clear()
            return pa.RecordBatch.from_pylist([row], schema=_arrow)

        for batch in batches:
            blocks = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // BLOCK
            for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(blocks)) + 1):
                some = batch.take(pa.array(rows))
                packed = encoder.encode(some.column(1))
                for doc_id, ids in zip(some.column(0).to_pylist(), packed):
                    doc_ids.append(_NULL if doc_id is None else doc_id)
                    parts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= SHARD:
                        yield close()
        if parts:
            yield close()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    return map_batches(slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), run, SCHEMA)


_arrow = pa.schema(
    [("shard", pa.int64()), ("n_tokens", pa.int64()), ("first", pa.int32())]
    + [(c, pa.binary()) for c in ("doc_ids", "doc_lengths", "rules", "lengths", "sequence")]
)


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the files to ``path``. Row groups stay small, since a row is some megabytes."""
    shards(docs, tokenizer).write.option("parquet.block.size", 1 << 25).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def contents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files.

    Only counts pass through the running sum over shards, of which there is one per ``SHARD`` ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["first"], row["rules"], row["lengths"], row["sequence"])
                ids = shard.ids().astype("<u4").tobytes()
                sizes = np.frombuffer(row["doc_lengths"], "<u8").astype(np.int64)
                starts = np.cumsum(sizes) - sizes
                crcs = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for a, n in zip(starts.tolist(), sizes.tolist())]
                names = np.frombuffer(row["doc_ids"], "<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(crcs), pa.int64()), pa.array(names, mask=names == _NULL),
                        pa.array(starts), pa.array(sizes), pa.array(crcs, pa.int64()),
                    ],
                    ["shard", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset"))
    found = map_batches(files, run, "shard long, doc_id long, place long, n_tokens long, ids_crc32 long")
    return found.join(offsets, "shard").select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def op2_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents`, written as token files and read back."""
    import public_tokenizers

    path = work_folder(spark, "token-files")
    write(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return contents(read(spark, path))
