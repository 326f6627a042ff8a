"""The registered queries against their SQL, or against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from lodeworks.llm import language_model, url_filter
from lodeworks.llm.queries import ORACLE, QUERIES
from tests.differential import difference, open_tables

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet'").fetchall())


def result(spark, name):
    return [tuple(r) for r in QUERIES[name](spark, SF_DIR).collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), open_tables(SF_DIR), ORACLE[name]) is None


def test_token_files(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    expected, start = set(), 0
    for doc_id in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        expected.add((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert set(result(spark, "op2_repair_token_files")) == expected


def test_simhash(spark, texts):
    prints = {}
    for doc_id, text in texts.items():
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    bits = np.array([prints[i] for i in ids], np.uint64)
    component = np.arange(len(ids))
    linked = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 3
    while True:
        lower = np.where(linked, component[None, :], len(ids)).min(1)
        if (lower == component).all():
            break
        component = lower
    expected = {(i, format(prints[i], "016x"), ids[c]) for i, c in zip(ids, component)}
    assert set(result(spark, "op3_simhash_tiles")) == expected


def test_bpe(spark, texts):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for doc_id, text in texts.items():
        ids = np.array(encoding.encode_ordinary(text), "<u4").tobytes()
        expected.add((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert set(result(spark, "op4_bpe_rank_queue")) == expected


def _winnowed(text, gram=5, window=8):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if words and (len(words) < gram + window - 1 or len(text) > 24 * len(words)):
        words = re.findall(r"[^\x20\x09-\x0D]", text)
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42).to_bytes(8, "little") for w in words]
    grams = []
    for i in range(max(1, len(hashes) - gram + 1) if hashes else 0):
        seed = 42
        for h in hashes[i : i + gram]:
            seed = xxhash.xxh64_intdigest(h, seed)
        grams.append(seed & (2**31 - 1))
    chosen = []
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        h, place = min((grams[j], -j) for j in range(i, min(len(grams), i + window)))
        if not chosen or chosen[-1] != (h, -place):
            chosen.append((h, -place))
    return chosen


def _alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing(spark, texts):
    order = sorted(texts, reverse=True)
    found = {i: _winnowed(t) for i, t in texts.items()}
    expected = set()
    for i, nxt in zip(order, order[1:] + order[:1]):
        text, third = texts[i], len(texts[i]) // 3
        edited = text[: len(text) - third] + texts[nxt][:third]
        other = _winnowed(edited)
        out = [" ".join(f"{h:X}:{p}" for h, p in f) for f in (found[i], other)]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        expected.add((i, len(text), sha, *out, _alike(found[i], other), _alike(found[i], found[nxt])))
    assert set(result(spark, "op6_winnowing")) == expected


def test_url_filter(spark):
    model = url_filter.Model(url_filter.labelled_urls())
    expected = set()
    for page_id, url in duckdb.sql(f"SELECT page_id, url FROM '{SF_DIR}/pages.parquet'").fetchall():
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = host.lower()
        fits = [
            (on + start, says) for says, on, start in url_filter.RULES
            if (host == on or host.endswith("." + on)) and path.startswith(start)
        ]
        rule, verdict = max(fits, key=lambda r: len(r[0]), default=(None, None))
        expected.add((page_id, host, path, rule, verdict or ("block" if model.margin(host, path) > 0 else "allow")))
    assert {r[:5] for r in result(spark, "op7_url_filter")} == expected


def test_log_bilinear(spark, texts):
    rows = {r[0]: r for r in result(spark, "op8_log_bilinear")}
    counts = Counter()
    for i, text in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(language_model.tokens(text.encode()))
    total, distinct = sum(counts.values()), len(counts)
    gains = []
    for i, text in texts.items():
        found = language_model.tokens(text.encode())
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in found)
        held = zlib.crc32(str(i).encode()) % 7 == 2
        assert rows[i][:5] == (i, held, len(found), sum(counts[t] > 0 for t in found), total)
        assert rows[i][5] == pytest.approx(base)
        if held:
            gains.append((rows[i][6] - rows[i][5], len(found)))
    assert len(rows) == len(texts)
    assert sum(g for g, _ in gains) > 0.15 * sum(n for _, n in gains)


def test_toxicity(spark):
    rows = {r[0]: r for r in result(spark, "op10_toxicity")}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR}/labels.parquet'").fetchall()
    held = [(rows[i], toxic) for i, toxic in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r[1] for r, _ in held) and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in rows.values())
    pairs = [(a[2] > b[2]) + 0.5 * (a[2] == b[2]) for a, t in held for b, f in held if t and not f]
    assert sum(pairs) / len(pairs) > 0.8
    assert sum(r[3] == toxic for r, toxic in held) / len(held) > 0.9
