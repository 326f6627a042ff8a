"""The pipeline held against a plain version of every stage."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from lodeworks.llm import bpe, toxicity
from lodeworks.llm.frames import documents
from tests.llm.odd import REST, odd
from tests.llm.test_near_copies import _kept

SF_DIR = "/root/testdata/sf0.01"


def _mixed(rows):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(r["text"].split())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    target, open_ = {}, set(sizes)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
            open_.remove(s)
    out = []
    for source in sizes:
        words, at = int(share.get(source, target.get(source, 0)) + 0.5), 0
        for r in sorted((r for r in rows if r["source"] == source), key=lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest()):
            size = len(r["text"].split())
            for turn in range(3):
                taken = max(0, min(size, words - turn * sizes[source] - at))
                if taken and 2 * taken >= size:
                    out.append(r["doc_id"])
            at += size
    return out


def test_run(spark):
    docs = documents(spark, SF_DIR)
    rows = [r.asDict() for r in docs.collect()]
    model = toxicity.learn(docs, toxicity.training_labels(spark, SF_DIR))
    clean = [r for r, s in zip(rows, model.score([r["text"] for r in rows])) if s < 0.5]
    last = {}
    for r in sorted(clean, key=lambda r: r["doc_id"]):
        last[r["text"]] = r
    unlike = _kept([(r["doc_id"], r["text"]) for r in last.values()])
    mixed = Counter(_mixed([r for r in last.values() if r["doc_id"] in set(unlike)]))
    encoder, texts = bpe.Encoder(*bpe.vocabulary()), {r["doc_id"]: r["text"] for r in rows}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in got) == mixed
    for r in got:
        assert r["ids_sha256"] == hashlib.sha256(encoder.encode(texts[r["doc_id"]])).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_toxic_rows_go_and_clean_rows_stay(spark):
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, documents(spark, SF_DIR), SF_DIR).select("doc_id").collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR}/labels.parquet'").fetchall()
    clean = [i in kept for i, toxic in labels if not toxic]
    assert sum(clean) >= 0.98 * len(clean)
    toxic = [i not in kept for i, toxic in labels if toxic]
    assert sum(toxic) >= 0.6 * len(toxic)  # this table has a few dozen labels to learn from


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_stages_on_odd_tables(spark, rows):
    docs = odd(spark) if rows == "odd" else odd(spark, [])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert all(r.asDict()[c] == value for r in out.collect() for c, value in REST.items()), name
        kept = out.select("doc_id", "text").collect()
        assert {(r[0], r[1]) for r in kept} <= {(r[0], r[1]) for r in docs.select("doc_id", "text").collect()}, name
        if name in ("exact_dedup", "simhash_near_dedup"):
            assert len(kept) == len(set(kept))
    corpus_pipeline.to_token_ids(spark, docs, SF_DIR).collect()


def test_order_of_the_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "byte_level_bpe"
    ]
