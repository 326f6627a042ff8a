"""Re-Pair goes on until no pair is left to replace."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from lodeworks.llm import token_files
from lodeworks.llm.token_files import LEAST_USES, Shard, _apart, repair


def _uses(sequence):
    """Places without overlap of each pair."""
    uses, last = Counter(), {}
    for i, pair in enumerate(zip(sequence.tolist(), sequence[1:].tolist())):
        if last.get(pair) != i - 1 or pair[0] != pair[1]:
            uses[pair] += 1
            last[pair] = i
    return uses


@pytest.mark.parametrize("kind", ["zipf", "runs", "copies", "blocking", "short"])
def test_no_pair_is_left(kind):
    rng = np.random.default_rng(1)
    if kind == "zipf":
        ids = np.minimum(rng.zipf(1.3, 60_000), 4_999)
    elif kind == "runs":
        ids = np.repeat(rng.integers(0, 9, 2_000), rng.integers(1, 40, 2_000))
    elif kind == "copies":
        some = rng.integers(0, 5_000, (200, 30))
        ids = np.concatenate([some[i] for i in rng.integers(0, 200, 2_000)])
    elif kind == "blocking":
        ids = np.tile([1, 2, 3, 1, 2, 4, 2, 3, 5, 3, 1], 7)
    else:
        ids = np.array([7, 7, 7])
    rules, lengths, sequence = repair(ids.astype(np.uint32), 5_000)
    assert max(_uses(sequence).values(), default=0) < LEAST_USES
    files = [x.astype("<u4").tobytes() for x in (rules, lengths, sequence)]
    assert Shard(5_000, *files).ids().tolist() == ids.tolist()


def test_places_apart_with_runs():
    """Of places in a row every second, from the first of each run of equals; the more frequent of two others."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        at = np.sort(rng.choice(120, rng.integers(1, 100), replace=False))
        counts = rng.integers(1, 4, len(at))
        count, taken, last = dict(zip(at.tolist(), counts.tolist())), [], None
        stay = [p for p in count if count[p] >= max(count.get(p - 1, 0), count.get(p + 1, 0))]
        for p in stay:
            if last != p - 1:
                taken.append(p)
            last = p if taken[-1] == p else None
        assert at[_apart(at, counts)].tolist() == taken


def test_rounds_look_at_few_places(monkeypatch):
    """Later rounds count only what may have become frequent, not the whole sequence again."""
    seen = []
    frequent = token_files._frequent
    monkeypatch.setattr(token_files, "_frequent", lambda seq, at, n: seen.append(len(at)) or frequent(seq, at, n))
    ids = np.random.default_rng(1).zipf(1.3, 60_000) % 5_000
    rules, lengths, sequence = repair(ids.astype(np.uint32), 5_000)
    assert seen[0] == len(ids) - 1 and len(seen) > 4 and seen[-1] < len(sequence) / 10 and sum(seen) < 4 * len(ids)


def test_late_rounds_do_not_scan_the_sequence():
    """Where few places count, closing a round looks at these alone; the result is that of a scan."""
    rng = np.random.default_rng(4)
    for n, few in ((50, 3), (3_000, 40), (3_000, 900)):
        sequence = rng.integers(0, 99, n).astype(np.uint32)
        at = np.sort(rng.choice(n - 1, few, replace=False))
        best = at[token_files._alternate(at)]
        may = np.zeros(n, bool)
        may[at] = True
        for places in (at, may):
            closed, found = token_files._closed(sequence, places, best)
            left = np.setdiff1d(np.arange(n), best + 1)
            new = np.searchsorted(left, best)
            expected = {*np.searchsorted(left, np.intersect1d(at, left)), *new, *(new - 1)} - {-1, len(left) - 1}
            assert closed.tolist() == sequence[left].tolist() and found.tolist() == sorted(expected)
