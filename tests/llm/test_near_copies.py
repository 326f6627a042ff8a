"""The near-dedup stage held against brute-force Jaccard similarity."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from lodeworks.llm import near_copies
from lodeworks.llm.frames import documents

SF_DIR = "/root/testdata/sf0.01"


def _shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def _kept(rows):
    """Ids of the rows with the smallest id of their component."""
    sets = [_shingles(text) for _, text in rows]
    name = list(range(len(rows)))

    def top(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                name[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(top(i), []).append(doc_id)
    return sorted(min(x) for x in least.values())


def _edited():
    """Texts with none to a tenth of their words replaced, chains of edits, and one line that all share."""
    rng, rows = random.Random(5), []
    for _ in range(12):
        words = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(rng.randrange(6, 300))]
        for _ in range(12):
            rows.append((rng.randrange(10**9), " ".join(words) + " one line that all of these texts have"))
            if rng.random() < 0.5:
                words = list(words)
            for at in rng.sample(range(len(words)), int(len(words) * rng.choice([0, 0.01, 0.02, 0.04, 0.1]))):
                words[at] = "new" + str(rng.randrange(10**6))
    return rows + [(1, None), (2, " \n"), (3, "One"), (4, "one"), (5, "one two")]


@pytest.mark.parametrize("heavy,crowd", [(near_copies.HEAVY, 512), (0, 512), (0, 1), (near_copies.HEAVY, 0)])
def test_edited_texts(spark, monkeypatch, heavy, crowd):
    monkeypatch.setattr(near_copies.keep, "__defaults__", (heavy,))
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    monkeypatch.setattr(near_copies, "COMPARED", 5)
    rows = _edited()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    assert sorted(r["doc_id"] for r in got.collect()) == _kept(rows)


@pytest.mark.parametrize("crowd", [near_copies.CROWD, 2])
def test_documents(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    docs = documents(spark, SF_DIR).select("doc_id", "text")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    assert sorted(r["doc_id"] for r in got.collect()) == _kept([(r[0], r[1]) for r in docs.collect()])


def test_a_null_id_gives_way(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (7, "A b c d e f"), (None, "alone")], "doc_id long, text string")
    assert {r[0] for r in near_copies.keep(docs).select("doc_id").collect()} == {7, None}


def test_a_line_that_all_texts_have_makes_few_pairs(spark, monkeypatch):
    """2,000 unlike texts that share five words whose hash comes first in the order: not the 1,999,000 pairs there are."""
    rng, first, compared = random.Random(8), [], []
    while not first:
        words = [rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(5)]
        if near_copies._set(" ".join(words).encode()).view(int)[0] < -(2**63) + 2**46:
            first = words
        if len(compared) > 2_000_000:
            raise AssertionError
        compared.append(1)
    compared.clear()
    rows = [(i, " ".join([*first, *(f"w{rng.randrange(10**9)}" for _ in range(60))])) for i in range(2000)]
    rows += [(5000 + i, text.rsplit(" ", 1)[0] + " changed") for i, (_, text) in enumerate(rows[:20])]
    real = near_copies._verified

    def counted(pairs, nodes, docs):
        compared.append(pairs.distinct().count())
        return real(pairs, nodes, docs)

    monkeypatch.setattr(near_copies, "_verified", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(r[0] for r in near_copies.keep(docs, 0).select("doc_id").collect())
    assert got == list(range(2000))
    assert sum(compared) < 10_000
