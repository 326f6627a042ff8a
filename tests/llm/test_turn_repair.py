"""Repair of conversations against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import cache

import duckdb
import pytest

from lodeworks.llm import turn_repair
from lodeworks.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
sys.setrecursionlimit(10_000)
_LEGAL = {"": "su", "s": "u", "u": "a", "a": "u"}


def _cheapest(rows):
    """Least (cost, audit) over all edits, by the roles that may follow the last one."""

    @cache
    def best(i, last, put_in):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if put_in < 3:
            ways += [(c + 3, "I" + a) for r in "ua" if r in _LEGAL[last] for c, a in [best(i, r, put_in + 1)]]
        if i < len(rows):
            initial, fault = rows[i]
            c, a = best(i + 1, last, 0)
            ways.append((c + 4, "D" + a))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                for letter, price, roles in (("K", 0, initial), ("R", 3, "ua")):
                    for r in roles:
                        if r in _LEGAL[last]:
                            c, a = best(i + 1, r, 0)
                            ways.append((c + price + more, letter + a))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def _plain(rows):
    """The query's rows from (conv_id, turn, role, text)."""
    left = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind, changed, named = zlib.crc32(key.encode()) % 20, text, role
        if kind == 1:
            changed = ""
        elif kind == 2:
            changed = re.sub("[.!?]", "", text)
        elif kind == 4:
            named = "user"
        order = (turn is not None, turn, role, hashlib.sha256(text.encode()).digest())
        left[conv_id] += [(order, turn, named, changed)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv_id, found in left.items():
        found.sort(key=lambda r: r[0])
        faults, seen = [], set()
        for _, _, role, text in found:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            if not solid:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in found]
        cost, audit = _cheapest(list(zip(initials, faults)))
        last, parts, queue = "", [], list(found)
        for letter in audit:
            row = queue.pop(0) if letter != "I" else (None, None, None, "")
            if letter == "D":
                continue
            role = row[2] if letter == "K" else {"u": "user", "a": "assistant"}[_LEGAL[last][-1]]
            parts.append(f"{role}:{row[3]}")
            last = role[:1]
        turns = {r[1] for r in found} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(parts).encode()).hexdigest()))
    empty = hashlib.sha256().hexdigest()
    return out + [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in {r[0] for r in rows} - set(left)]


def _in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_DIR}/conversations.parquet'").fetchall()
    got = QUERIES["op13_turn_repair"](spark, SF_DIR)
    assert got.columns[:9] == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert _in_order(got.collect()) == _in_order(_plain(rows))


@pytest.mark.parametrize("segment", [1, 3, 256])
def test_audits(monkeypatch, segment):
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    rng, kinds = random.Random(7), {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for _ in range(300):
        rows = [(rng.choice(["s", "u", "a", "t", "", " "]), rng.choice(["", "", *kinds])) for _ in range(rng.randrange(12))]
        assert turn_repair.audit([(i, kinds[f]) for i, f in rows]) == _cheapest(rows), rows


SCHEMA = "conv_id long, turn long, role string, text string, audit string, digest binary, initial string, fault int, is_row boolean, id long"


def odd_rows():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "", None]), rng.choice(["A.", "b", " \n", "", None, "A.", "é?"]))
            for c in [None, *range(60)] for t in rng.sample([None, *range(-3, 9)], rng.randrange(8))]
    rows += rng.sample(rows, 30)
    rows += [(99, t, "user" if t % 2 else "assistant", "long " * 2000) for t in range(300)]
    return rows + [(100, 1, "user", "x" * 3_000_000)]


@pytest.mark.parametrize("rows", [odd_rows(), []], ids=["odd", "empty"])
def test_odd_tables(spark, rows):
    df = spark.createDataFrame([(*r, "x", b"d", "i", 1, True, 5) for r in rows], SCHEMA).repartition(3)
    got = turn_repair.repair(df).collect()
    assert _in_order(got) == _in_order(_plain(rows))


def test_repaired_rows_follow_the_grammar(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    damaged = turn_repair.damage(rows)
    audited = turn_repair.audits(turn_repair.faults(damaged))
    found = defaultdict(dict)
    for r in turn_repair.repaired(damaged, audited).collect():
        found[r["conv_id"]][r["place"]] = r
    texts = {r["conv_id"]: r["repaired_sha256"] for r in turn_repair.digests(damaged, audited).collect()}
    for conv_id, digest in texts.items():
        turns = [found[conv_id][i] for i in range(len(found[conv_id]))] if conv_id in found else []
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in turns))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in turns).encode()).hexdigest() == digest
