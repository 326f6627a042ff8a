"""Hard negatives against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from lodeworks.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, bucket long, ids binary, anchor string, block long, length double, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, b"i", "a", 2, 0.5, 3) for r in rows], SCHEMA).repartition(3)


def brute(rows, every=100):
    """The query's rows, by integers of any size."""
    kept = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, whole))

    def score(a, b):
        return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a[2], b[2]))))

    out = []
    for at, anchor in enumerate(kept):
        if anchor[0] % every:
            continue
        scored = [(score(anchor, r), r) for i, r in enumerate(kept) if i != at and r[0] != anchor[0]]
        first = sorted([(-s, r[0]) for s, r in scored if r[1] == anchor[1]])[:5]
        others = [(score(anchor, r), r) for r in kept if r[1] != anchor[1]]
        for s, positive in first:
            fits = sorted((-n, r[0]) for n, r in others if 80 * -s <= 100 * n <= 100 * -s)[:5]
            out += [(anchor[0], positive, i, r, -s, -n) for i, (n, r) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, every=100):
    got = hard_negatives.mine(frame(spark, rows), every)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def some_rows(n, dims, seed, spread=1.0, classes=4):
    """Vectors of few dimensions and unlike lengths around a few directions, so that most can be left out."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(classes * 2, dims))
    place = rng.integers(0, len(centers), n)
    vectors = (centers[place] + spread * rng.normal(size=(n, dims)) * 0.2) * rng.lognormal(0, 1, (n, 1))
    return [(i, [float(np.float32(x)) for x in v], int(p) % classes) for i, (v, p) in enumerate(zip(vectors, place))]


@pytest.mark.parametrize("dims,bucket,part", [(3, 4 << 20, 2048), (3, 2000, 16), (24, 20_000, 64)])
def test_against_all_products(spark, monkeypatch, dims, bucket, part):
    monkeypatch.setattr(hard_negatives.buckets, "__defaults__", (bucket,))
    monkeypatch.setattr(hard_negatives.Bucket.parts, "__defaults__", (part,))
    monkeypatch.setattr(hard_negatives, "BLOCK", 300)
    rows = some_rows(700, dims, dims)
    assert mined(spark, rows, 20) == brute(rows, 20)


def test_candidates_hold_all_that_reach_the_cosine_and_leave_others_out():
    rows = np.floor(np.array([v for _, v, _ in some_rows(2000, 4, 9)]) * 256)
    part = hard_negatives.Part(np.arange(2000), np.zeros(2000), rows)
    lengths = np.linalg.norm(rows, axis=1)
    left_out = 0
    for i in range(0, 2000, 97):
        cosines = rows @ rows[i] / (lengths * lengths[i])
        for least in (0.3, 0.9, 0.99, 1.0):
            found = part.candidates(rows[i] / lengths[i], least * (1 - 1e-9), np.argsort(-np.abs(rows[i]))[:3])
            reached = np.flatnonzero(cosines >= least)
            assert found is None or set(reached) <= set(found.tolist())
            left_out += 0 if found is None else 2000 - len(found)
    assert left_out > 20_000


def odd_rows():
    rng = random.Random(2)
    few = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(120)]
    nan, inf = float("nan"), float("inf")
    return few + [
        (None, [1.0, 1.0, 1.0], 0), (200, None, 0), (300, [1.0, 1.0, 1.0], None), (400, [1.0, None, 1.0], 1), (500, [nan, 1.0, 1.0], 1),
        (600, [1.0, inf, 1.0], 1), (700, [], 1), (800, [1.0], 2), (900, [1.0, 1.0, 1.0, 1.0, 1.0], 2), (1000, [0.0, 0.0, 0.0], 0),
        (1100, [3e4, 3e4, 1.0], 0), (1101, [3e4, 2.9e4, 1.0], 0), (1102, [3e4, 2.8e4, 1.0], 1), (1200, [-1.0, -1.0, -1.0], 5),
        (-100, [1.0, 0.5, 0.5], 1), (100, [1.0, 0.5, 0.5], 1), (100, [1.0, 0.5, 0.5], 1),
    ]


def test_odd_rows(spark):
    assert mined(spark, odd_rows()) == brute(odd_rows())


def test_huge_components(spark):
    rows = [(i, [x, 1.0], i % 2) for i, x in enumerate([1e30, 1e25, 9e6, 8e6, 2.0, 1.0] * 3)] + [(100, [1e30, 1.0], 0), (200, [8e6, 3.0], 1)]
    assert mined(spark, rows) == brute(rows)


def test_one_label_and_equal_vectors(spark):
    """A third of all rows of one label and one vector, ties in every rank."""
    rows = [(i, [0.5, 0.5], 1 if i % 3 else 2) for i in range(301)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
