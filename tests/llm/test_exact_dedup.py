"""Exact dedup against its SQL, over several deliveries, and on odd tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from lodeworks.llm import exact_dedup
from lodeworks.llm.exact_dedup import DigestIndex
from tests.llm.odd import ROWS, odd


def decisions(spark, docs, path):
    stamped = exact_dedup.stamp(docs)
    index = DigestIndex(spark, path, 4)
    index.absorb(stamped)
    return [tuple(r) for r in exact_dedup.decide(stamped, index).collect()]


def test_odd_rows(spark, tmp_path):
    groups = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(doc_id)
    expected = Counter()
    for digest, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        expected.update((i, digest, best, len(ids), i == best) for i in ids)
    assert Counter(decisions(spark, odd(spark), str(tmp_path))) == expected


def test_empty(spark, tmp_path):
    assert decisions(spark, odd(spark, []), str(tmp_path)) == []


def test_keep_has_one_row_per_text_and_all_columns(spark, tmp_path):
    docs = odd(spark)
    index = DigestIndex(spark, str(tmp_path), 4)
    index.absorb(exact_dedup.stamp(docs))
    kept = exact_dedup.keep(docs, index)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    best = {}
    for doc_id, text, *_ in ROWS:
        best[text or ""] = max(best.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert sorted((-1 if i is None else i, t) for i, t in got) == sorted((i, t) for t, i in best.items())


def test_later_deliveries_meet_the_index(spark, tmp_path):
    def delivery(*rows):
        return exact_dedup.stamp(spark.createDataFrame(list(rows), "doc_id long, text string"))

    path = str(tmp_path)
    DigestIndex(spark, path, 4).absorb(delivery((1, "a"), (2, "b")))
    opened = DigestIndex(spark, path)  # another session would find it the same way
    assert opened.buckets == 4
    second = delivery((3, "a"), (4, "c"), (5, "c"))
    opened.absorb(second)
    opened.absorb(second)  # repeated after a crash
    assert {r["keep_id"] for r in opened.rows().collect()} == {1, 2, 5}
    assert opened.rows().count() == 3
    opened.forget()


def test_index_side_of_the_anti_join_is_not_shuffled(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path), 8)
    index.absorb(exact_dedup.stamp(odd(spark)))
    new = exact_dedup.stamp(odd(spark)).groupBy("digest").count()
    plan = new.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text and "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 1
