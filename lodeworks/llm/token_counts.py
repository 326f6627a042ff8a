"""Token counts by a tokenizer that is compiled into finite-state transducers.

A byte-level BPE file becomes two deterministic machines.

`Splitter` reads kinds of characters and says where pre-tokens begin. It has a dozen states, so that a chunk of text
is a map from every state before it to the state after it; the maps of all chunks of a batch are made side by side,
composed by a parallel prefix scan, and then each chunk is read once more from the state it is really entered in.

`Merges` reads the bytes of a pre-token, and each of its transitions carries the number of tokens that the byte adds
to the text so far: one for a new token, less than one where the byte lets earlier tokens merge. It rests on this:
tokens side by side are what BPE makes of their bytes exactly if every two neighbours are what it makes of theirs.
So the last token of a text is the only one that ends there and bears with the last token of the text before it.
A state holds, for every place where a token that is still unfinished may have begun, its bytes so far (a node of
the trie of tokens), the token before it, and how many tokens that place is away. That's finite, as tokens are; only
the states that texts lead to are ever made. The count of a long text is the sum of the numbers on its way.

What is kept of states, transitions and pre-tokens is bounded, and made anew when it is full.

Edge cases: a null text counts as empty and has no tokens; texts of any length are read in blocks, whatever the
length of a pre-token; special tokens inside texts count as one, as the library counts them unless told otherwise;
repeated rows give repeated results; an empty table gives an empty result; other columns of the input are not read,
whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.llm.frames import documents, map_batches, text_of

#: Characters read at once, and those of a chunk that has a map of its own.
BLOCK, CHUNK = 1 << 20, 64
#: What a worker keeps: transitions between states, results of pre-tokens, and the longest such pre-token in bytes.
STEPS, KEPT, LONGEST = 1_000_000, 300_000, 48
#: A text of more tokens is over the limit.
LIMIT = 512

#: White space as Unicode's White_Space has it, and the endings that follow an apostrophe as a token.
_BLANKS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

# Kinds of characters. Letters that begin or end an ending of two letters have kinds of their own.
_LETTER, _WHOLE, _BEFORE_E, _E, _EL, _NUMBER, _OTHER, _APOSTROPHE, _SPACE, _BLANK, _END = range(11)
_KINDS = 11
_LETTERS = (_LETTER, _WHOLE, _BEFORE_E, _E, _EL)
# States: what the pre-token that is being read consists of so far.
(_START, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _MARK, _MARK_RV, _MARK_L, _ENDED,
 _ONE_SPACE, _ONE_BLANK, _RUN_SPACE, _RUN_BLANK) = range(12)
_STATES = 12
#: What a transition says: a pre-token begins here, or at the character before.
_HERE, _BACK = 1, 2


def _kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every, place = "".join(map(chr, points)), np.array(points)
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (f"[{_BLANKS}]+", _BLANK)):
        for run in regex.finditer(pattern, every):
            kinds[place[run.start() : run.end()]] = kind
    for c, kind in ((" ", _SPACE), ("'", _APOSTROPHE), ("e", _E), ("l", _EL)):
        kinds[ord(c)] = kind
    for ending in _ENDINGS:
        if ending != "ll":
            kinds[ord(ending[0])] = _WHOLE if len(ending) == 1 else _BEFORE_E
    return kinds


class Splitter:
    """Where pre-tokens begin: an ending after an apostrophe; or letters, numbers, or other characters, each with
    at most one space before; or white space, which leaves its last character to what follows.
    """

    def __init__(self):
        self.kinds = _kinds()
        self.next = np.zeros((_STATES, _KINDS), np.uint8)
        self.says = np.zeros((_STATES, _KINDS), np.uint8)
        begun = {k: _IN_LETTERS for k in _LETTERS} | {
            _NUMBER: _IN_NUMBERS, _OTHER: _IN_OTHERS, _APOSTROPHE: _MARK, _SPACE: _ONE_SPACE, _BLANK: _ONE_BLANK, _END: _START
        }
        joined = {**begun, _APOSTROPHE: _IN_OTHERS}
        for state in range(_STATES):
            for kind in range(_KINDS):
                self._set(state, kind, begun[kind], _HERE)
        for kind in _LETTERS:
            self._set(_IN_LETTERS, kind, _IN_LETTERS, 0)
        self._set(_IN_NUMBERS, _NUMBER, _IN_NUMBERS, 0)
        for state in (_IN_OTHERS, _MARK):
            for kind in (_OTHER, _APOSTROPHE):
                self._set(state, kind, _IN_OTHERS, 0)
        for kind, state in ((_WHOLE, _ENDED), (_BEFORE_E, _MARK_RV), (_EL, _MARK_L)):
            self._set(_MARK, kind, state, 0)
        for state, last in ((_MARK_RV, _E), (_MARK_L, _EL)):
            for kind in range(_KINDS):
                if kind in _LETTERS:  # no ending after all: letters that began one character ago
                    self._set(state, kind, _IN_LETTERS, _BACK)
                else:
                    self._set(state, kind, begun[kind], _BACK | _HERE)
            self._set(state, last, _ENDED, 0)
        solid = (*_LETTERS, _NUMBER, _OTHER, _APOSTROPHE)
        for kind in solid:
            self._set(_ONE_SPACE, kind, joined[kind], 0)
            self._set(_RUN_SPACE, kind, joined[kind], _BACK)
            self._set(_RUN_BLANK, kind, begun[kind], _BACK | _HERE)
        for state in (_ONE_SPACE, _ONE_BLANK, _RUN_SPACE, _RUN_BLANK):
            self._set(state, _SPACE, _RUN_SPACE, 0)
            self._set(state, _BLANK, _RUN_BLANK, 0)
        # Transitions in one row after another, and the row of the next state.
        self._rows, self._said = (self.next * _KINDS).astype(np.uint8).ravel(), self.says.ravel()

    def _set(self, state: int, kind: int, to: int, says: int) -> None:
        self.next[state, kind], self.says[state, kind] = to, says

    def maps(self, kinds: np.ndarray) -> np.ndarray:
        """The state after each row of ``kinds`` (place, chunk) for every state (state, chunk) before it."""
        row = np.repeat(np.arange(_STATES, dtype=np.uint8) * np.uint8(_KINDS), kinds.shape[1]).reshape(_STATES, -1)
        for kind in kinds:
            row += kind
            row = self._rows[row]
        return row // np.uint8(_KINDS)

    @staticmethod
    def scan(maps: np.ndarray) -> np.ndarray:
        """Each map (state, chunk) composed with all before it, in as many rounds as the number of chunks has bits."""
        whole, step = maps, 1
        while step < whole.shape[1]:
            composed = np.take_along_axis(whole[:, step:], whole[:, :-step].astype(np.intp), 0)
            whole = np.concatenate([whole[:, :step], composed], 1)
            step *= 2
        return whole

    def read(self, kinds: np.ndarray, state: int = _START, chunk: int | None = None) -> tuple[np.ndarray, int]:
        """What the transitions over ``kinds`` say, and the state after them."""
        chunk = chunk or CHUNK
        whole = len(kinds) // chunk * chunk
        says = np.zeros(len(kinds), np.uint8)
        if whole:
            chunks = np.ascontiguousarray(kinds[:whole].reshape(-1, chunk).T)
            after = self.scan(self.maps(chunks))[state]
            row = np.concatenate([[state], after[:-1]]).astype(np.uint8) * np.uint8(_KINDS)
            said = np.empty_like(chunks)
            for place, kind in enumerate(chunks):
                row += kind
                said[place] = self._said[row]
                row = self._rows[row]
            says[:whole] = said.T.ravel()
            state = int(after[-1])
        for place in range(whole, len(kinds)):
            says[place], state = self.says[state, kinds[place]], int(self.next[state, kinds[place]])
        return says, state


class Merges:
    """The transducer of a list of merges. Symbols are the bytes, then a symbol for each merge in order."""

    def __init__(self, merges: Sequence[tuple[bytes, bytes]]):
        symbol = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if a not in symbol or b not in symbol or a + b in symbol:
                raise ValueError("merges must build every token once, of tokens that come before it")
            symbol[a + b] = self.pairs[symbol[a], symbol[b]] = len(self.parts)
            self.parts.append((symbol[a], symbol[b]))
        made = [True] * len(self.parts)
        for at in range(256, len(self.parts)):
            a, b = self.parts[at]
            made[at] = made[a] and made[b] and self.apart(a, b, at)
        # The trie of the tokens that BPE makes; a node's token or -1, and whether longer tokens go through it.
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for text, at in symbol.items():
            if made[at]:
                node = 0
                for b in text:
                    self.inner[node] = True
                    node = self.child.setdefault(node << 8 | b, len(self.token))
                    if node == len(self.token):
                        self.token.append(-1)
                        self.inner.append(False)
                self.token[node] = at
        self._bear: dict[int, bool] = {}
        self._begin()

    def apart(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether BPE of the bytes of ``a`` and ``b`` gives these two; merges from ``before`` on don't count.

        The later of the merges that the two come from is taken back again and again. Each time what then touches at
        the border must not be a pair that would have been merged first.
        """
        first = len(self.parts) if before is None else before
        while True:
            if self.pairs.get((a, b), first) < first:
                return False
            if max(a, b) < 256:
                return True
            if a > b:
                first, a = a, self.parts[a][1]
            else:
                first, b = b + 1, self.parts[b][0]  # of equal pairs the left one is merged first

    def _bears(self, a: int, b: int) -> bool:
        found = self._bear.get(key := a << 32 | b)
        if found is None:
            if len(self._bear) >= STEPS:
                self._bear.clear()
            found = self._bear[key] = self.apart(a, b)
        return found

    def _begin(self) -> None:
        start = ((0, -1, 0),)
        self._states, self._ids, self._steps = [start], {start: 0}, {}

    def _id(self, state: tuple) -> int:
        found = self._ids.setdefault(state, len(self._states))
        if found == len(self._states):
            self._states.append(state)
        return found

    def _step(self, state: int, byte: int) -> int:
        """A new transition: the state after ``byte`` and what it adds to the count, as one number."""
        more, last, added = [], -1, 0
        for node, before, away in self._states[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if token >= 0 and (before < 0 or self._bears(before, token)):
                last, added = token, away + 1
            if self.inner[node]:
                more.append((node, before, away))
        after = ((0, last, 0), *[(node, before, away - added) for node, before, away in more])
        full = len(self._steps) >= STEPS
        if full:
            self._begin()
        step = self._id(after) << 32 | added + (1 << 31)
        if not full:
            self._steps[state << 8 | byte] = step
        return step

    def read(self, text: bytes, state: int = 0, count: int = 0) -> tuple[int, int]:
        """State and count after ``text``. States are good until the next call."""
        known, new = self._steps.get, self._step
        for byte in text:
            step = known(state << 8 | byte)
            if step is None:
                step = new(state, byte)
                known = self._steps.get
            state = step >> 32
            count += (step & 0xFFFFFFFF) - (1 << 31)
        return state, count

    def state(self, at: int) -> tuple:
        """A state as it can be kept; `resume` gives its number."""
        return self._states[at]

    def resume(self, state: tuple) -> int:
        return self._id(state)


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in the file: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Token counts as the library gives them for a byte-level BPE file, special tokens inside texts included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            found = json.load(lines)
        self._require(found)
        alphabet = _byte_alphabet()
        spelled = [m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"]]
        self.merges = Merges([tuple(bytes([alphabet[c] for c in part]) for part in m) for m in spelled])
        special = sorted((t["content"] for t in found.get("added_tokens") or ()), key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self.splitter = Splitter()
        self._kept: dict[bytes, int] = {}
        self._older: dict[bytes, int] = {}

    @staticmethod
    def _require(found: dict) -> None:
        model, split = found["model"], found.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE" and not any(model.get(k) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and found.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space")
            and not any(t[k] for t in found.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            raise ValueError("only byte-level BPE files without normalizer can be compiled")

    def _new(self, piece: bytes) -> int:
        """The count of a pre-token that isn't among the newest kept."""
        count = self._older.get(piece)
        if count is None:
            count = self.merges.read(piece)[1]
        if len(piece) <= LONGEST:
            if len(self._kept) >= KEPT:
                self._kept, self._older = {}, self._kept
            self._kept[piece] = count
        return count

    def _blocks(self, texts: Sequence[str], totals: np.ndarray) -> Iterator[tuple[str, list[int], np.ndarray, np.ndarray]]:
        """Texts in blocks: characters, where an end stands among them, and where which text begins."""
        parts, ends, begins, owners, size = [], [], [], [], 0
        for owner, text in enumerate(texts):
            between = self._special.split(text) if self._special else [text]
            totals[owner] += len(between) - 1
            for part in between:
                for at in range(0, len(part), BLOCK):
                    piece = part[at : at + BLOCK]
                    begins.append(size)
                    owners.append(owner)
                    parts.append(piece)
                    size += len(piece)
                    if at + BLOCK >= len(part):
                        ends.append(size)
                        parts.append("\n")
                        size += 1
                    if size >= BLOCK:
                        yield "".join(parts), ends, np.array(begins), np.array(owners)
                        parts, ends, begins, owners, size = [], [], [], [], 0
        if size:
            yield "".join(parts), ends, np.array(begins), np.array(owners)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """The number of tokens of every text."""
        totals = np.zeros(len(texts), np.int64)
        merges, known, new = self.merges, self._kept.get, self._new
        state, held, held_says, way, open_ = _START, "", 0, None, 0
        for block, ends, begins, owners in self._blocks(texts, totals):
            kinds = self.splitter.kinds[np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4")]
            kinds[ends] = _END
            says, state = self.splitter.read(kinds, state)
            if held:  # the last character of the block before, which this one may begin a pre-token at
                block, kinds, says = held + block, np.append(_OTHER, kinds), np.append(held_says, says)
                begins = np.append(0, begins[1:] + 1) if len(begins) else begins
            says[:-1] |= says[1:] >> 1 & _HERE
            starts = np.flatnonzero(says & _HERE)
            codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4")
            sizes = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
            places = np.concatenate([[0], np.cumsum(sizes)])
            data = block.encode("utf-8", "surrogatepass")
            closed = kinds[-1] == _END
            # What is read now: all, or all but the last character.
            last = len(block) if closed else len(block) - 1
            head = int(places[starts[0]] if len(starts) and starts[0] < last else places[last])
            if way is not None:
                at, open_ = merges.read(data[:head], merges.resume(way), open_)
                way = merges.state(at)
                if len(starts):
                    totals[owners[0]] += open_
                    way, open_ = None, 0
            inside = starts[starts < last]
            bounds = places[np.append(inside, last)].tolist()
            open_at = bounds.pop(-2) if not closed and len(inside) and not (starts[-1] == last) else None
            if open_at is not None:
                bounds.pop()
                bounds.append(open_at)
                inside = inside[:-1]
            found = [known(p) or new(p) for p in (data[a:b] for a, b in pairwise(bounds))]
            known = self._kept.get
            found = np.array(found, np.int64)
            found[kinds[inside] == _END] = 0
            np.add.at(totals, owners[np.searchsorted(begins, inside, "right") - 1], found)
            if closed:
                held, held_says = "", 0
                continue
            held, held_says = block[-1], int(says[-1] & _HERE)
            if open_at is not None:
                at, open_ = merges.read(data[open_at : int(places[last])])
                way = merges.state(at)
        return totals


_open: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, compiled once per Python worker."""
    if path not in _open:
        _open[path] = Tokenizer(path)
    return _open[path]


def counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text, by the byte-level BPE file at ``path`` on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = pa.array(compiled.counts(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found], ["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    slim = slim.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), "body")
    return map_batches(slim, run, "doc_id long, n_bytes long, n_tokens long")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `documents` by the public byte-level vocabulary of 50,000 merges."""
    import public_tokenizers

    counted = counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
