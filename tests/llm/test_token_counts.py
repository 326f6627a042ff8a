"""Token counts against the tokenizers library."""

from __future__ import annotations

import json
import random
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodeworks.llm import token_counts
from lodeworks.llm.queries import QUERIES
from tests.llm.odd import ROWS, odd

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")

BITS = (
    "'s 're 'r 'l 'll 't ' '' ve a the tion 1 23 ! ... é 中文 \U0001f600 <|endoftext|> <|endof xxxxxxxxx Ⅷ ी ing E L".split()
    + [" ", "  ", "\n", "\t", "\r\n", " ", "\u0085", "\x00", "　", " ", "\x1c"]
)


@cache
def compiled():
    return token_counts.Tokenizer(PATH)


@cache
def library():
    return Tokenizer.from_file(PATH)


def expected(texts):
    return [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]


def some_texts(n):
    rng = random.Random(4)
    mixed = ["".join(rng.choice(BITS) for _ in range(rng.randrange(40))) for _ in range(n)]
    ranges = (lambda: rng.randrange(32, 127)), (lambda: rng.randrange(0x250)), (lambda: rng.randrange(0x2FF0, 0x3100))
    return mixed + ["".join(chr(rng.choice(ranges)()) for _ in range(rng.randrange(60))) for _ in range(n // 2)]


@pytest.mark.parametrize("block,chunk", [(1 << 20, 64), (1, 1), (2, 5), (7, 3), (100, 64)])
def test_texts_of_all_kinds(monkeypatch, block, chunk):
    """Whatever the borders of blocks and chunks."""
    monkeypatch.setattr(token_counts, "BLOCK", block)
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    texts = some_texts(3000)
    assert compiled().counts(texts).tolist() == expected(texts)


def test_tables_that_are_often_full(monkeypatch):
    monkeypatch.setattr(token_counts, "STEPS", 50)
    monkeypatch.setattr(token_counts, "KEPT", 20)
    monkeypatch.setattr(token_counts, "BLOCK", 1000)
    texts = [*some_texts(300), "abcdefgh" * 3000]
    assert token_counts.Tokenizer(PATH).counts(texts).tolist() == expected(texts)


def test_long_pre_tokens():
    rng = random.Random(1)
    texts = ["x" * 300_000, "".join(rng.choice("abcdefghij") for _ in range(1_200_000)), " " * 50_000 + "a", "-" * 70_000]
    assert compiled().counts(texts).tolist() == expected(texts)


def test_maps_compose():
    """The scan of chunk maps against one state after another."""
    rng, splitter = np.random.default_rng(2), compiled().splitter
    kinds = rng.integers(0, 10, (37, 8)).astype(np.uint8)
    scanned = splitter.scan(splitter.maps(np.ascontiguousarray(kinds.T)))
    for entered in range(12):
        state = entered
        for at, chunk in enumerate(kinds):
            for kind in chunk:
                state = splitter.next[state, kind]
            assert scanned[entered, at] == state


def test_neighbours_that_stay_apart():
    merges = compiled().merges
    rng, texts = random.Random(3), {}
    for at, (a, b) in enumerate(merges.parts):
        texts[at] = bytes([a]) if at < 256 else texts[a] + texts[b]
    common = [at for at, t in texts.items() if t.isalpha()]  # one pre-token whatever they are put beside
    for a, b in ((rng.choice(common), rng.choice(common)) for _ in range(3000)):
        ids = library().encode((texts[a] + texts[b]).decode()).ids
        assert merges.apart(a, b) == (ids == [library().token_to_id(texts[x].decode()) for x in (a, b)])


def test_files_that_cannot_be_compiled(tmp_path):
    found = json.load(open(PATH))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"model": {**found["model"], "ignore_merges": True}}):
        path = tmp_path / "changed.json"
        path.write_text(json.dumps({**found, **change}))
        with pytest.raises(ValueError):
            token_counts.Tokenizer(str(path))


def test_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet'").fetchall()
    want = {(i, len(t.encode()), n, n > 512) for (i, t), n in zip(rows, expected([t for _, t in rows]))}
    got = QUERIES["op12_token_counts"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd", "empty"])
def test_odd_tables(spark, rows):
    texts = [r[1] or "" for r in rows]
    want = Counter((r[0], len(t.encode()), n) for r, t, n in zip(rows, texts, expected(texts)))
    assert Counter(tuple(r) for r in token_counts.counts(odd(spark, rows), PATH).collect()) == want
