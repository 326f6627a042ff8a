"""The near-dedup stage finds its pairs by fingerprints within a radius, and compares these exactly."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from lodeworks.llm import near_copies, near_simhash
from tests.llm.test_near_copies import _edited, _kept


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def _run(spark, rows):
    return sorted(r[0] for r in corpus_pipeline.drop_near_copies(spark, _docs(spark, rows), "").select("doc_id").collect())


def test_the_stage_goes_by_fingerprints(spark, monkeypatch):
    """With a radius of zero only equal fingerprints are compared, so that edited texts stay."""
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:100], "new", *words[101:]])), (3, "another text")]
    assert _run(spark, rows) == [1, 3]
    for name in ("RADIUS", "SMALL_RADIUS", "HALF_RADIUS"):
        monkeypatch.setattr(near_simhash, name, 0)
    assert _run(spark, rows) == [1, 2, 3]


def test_small_tiles_and_squares(spark, monkeypatch):
    monkeypatch.setattr(near_simhash, "TILE", 7)
    monkeypatch.setattr(near_simhash, "CELLS", 20)
    monkeypatch.setattr(near_simhash, "SIDE", 3)
    rows = _edited()
    assert _run(spark, rows) == _kept(rows)


def test_a_passage_of_many_unlike_texts_sends_none_of_them(spark, monkeypatch):
    """400 texts that share a third of their words: the prefixes of their sets meet, their fingerprints don't."""
    rng, sent = random.Random(3), []
    passage = [f"p{rng.randrange(10**9)}" for _ in range(30)]
    rows = [(i, " ".join([*passage, *(f"w{rng.randrange(10**9)}" for _ in range(60))])) for i in range(400)]
    rows += [(1000 + i, text + " more") for i, (_, text) in enumerate(rows[:20])]
    real = near_copies._verified

    def counted(pairs, nodes, docs):
        sent.append(pairs.distinct().count())
        return real(pairs, nodes, docs)

    monkeypatch.setattr(near_copies, "_verified", counted)
    assert _run(spark, rows) == list(range(400))
    assert sum(sent) < 500


def test_the_first_quarter_is_the_majority_of_the_hashes():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 301).astype(np.uint64) * np.uint64(2)
    plain = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes) > len(hashes))
    assert int(near_simhash.fingerprint(hashes)[0]) == plain
