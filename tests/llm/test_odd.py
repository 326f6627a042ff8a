"""Every operator on tables with nulls, ties, repeats, long and empty texts, clashing columns, and no rows."""

from __future__ import annotations

import hashlib
import math
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodeworks.llm import bpe, language_model, licenses, mixing, simhash, token_files, toxicity, url_filter, winnowing
from lodeworks.llm.frames import text_of
from lodeworks.storage import work_folder
from tests.llm.odd import ROWS, odd
from tests.llm.test_queries import _winnowed


@pytest.fixture(params=["odd", "empty"])
def docs(request, spark):
    return odd(spark, ROWS if request.param == "odd" else [])


def rows_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_license_scan(spark, docs):
    got = licenses.scan(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows_of(docs))
    assert all(r["license"] is None and r["n_notices"] == 0 for r in got)


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", ";; ", "-- "])
@pytest.mark.parametrize("width", [40, 72, 100, 10_000])
def test_licenses_in_any_wrapping(spark, mark, width):
    """Every whole text, wrapped and commented as files have it, below a line that names the holder."""
    rows, names = [], {}
    for at, (name, body) in enumerate(k for k in licenses.KNOWN if len(k[1]) > 150):
        lines = ["Copyright (c) 2020-2024 Ann Author <ann@example.org>", "(c) 2019 others", ""]
        for paragraph in body.split("\n\n"):
            lines += [*textwrap.wrap(paragraph, width, break_long_words=False, break_on_hyphens=False), ""]
        rows.append((at, "\n".join(mark + x for x in lines)))
        names[at] = name
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in got} == names and len(names) > 20


def test_license_prose_and_neighbours_are_kept(spark):
    known = [("x", "copyright notice here"), ("y", "a license license b"), ("z", "(c) you must keep it")]
    rows = [(1, "Copyright notice\nhere"), (2, "a licence licence b"), (3, "Copyright 2020 me\n(c) You must keep it"), (4, "(c)")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    assert {r["doc_id"]: r["license"] for r in got} == {1: "x", 2: "y", 3: "z", 4: None}


def test_license_of_whole_texts_and_lines(spark):
    mit = licenses.KNOWN[0][1]
    changed = mit.replace("MIT License\n", "MIT Licence\n\nCopyright (c) 2020 A. Person, all rights reserved\n").upper()
    rows = [
        (1, changed.replace("SUBLICENSE", "sub-licence")), (2, "prose\nreleased under the MIT licence\nmore"),
        (3, mit + " except on Sundays"), (4, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\nSPDX-License-Identifier: MIT"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["license"] for i in (1, 2, 3, 4)] == ["MIT", None, None, None]
    assert [got[i]["notices"] for i in (1, 2, 3, 4)] == ["", "MIT", "", "CC-BY-NC-4.0,MIT"]
    assert [got[i]["n_notices"] for i in (1, 2, 3, 4)] == [0, 1, 0, 3]


def test_token_files(spark, docs, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = work_folder(spark, "token-files")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter((i, len(tokenizer.encode(t).ids) + 1) for i, t in rows_of(docs))
    got = sorted(token_files.contents(token_files.read(spark, path)).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == expected
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
    assert [r["doc_id"] for r in got if r["doc_id"] is not None] == sorted(i for i, _ in rows_of(docs) if i is not None)


@pytest.mark.parametrize("kind", ["random", "words", "one", "none", "single"])
def test_repair_round_trip(kind):
    random = np.random.default_rng(3)
    words = [random.integers(0, 900, random.integers(1, 6)) for _ in range(200)]
    ids = {
        "random": random.integers(0, 50_000, 20_000), "one": np.full(10_001, 7), "none": np.zeros(0), "single": np.array([5]),
        "words": np.concatenate([words[i] for i in random.zipf(1.3, 20_000) % 200]),
    }[kind].astype(np.uint32)
    rules, lengths, sequence = token_files.repair(ids, 50_257)
    shard = token_files.Shard(50_257, rules.tobytes(), lengths.tobytes(), sequence.tobytes())
    assert len(shard) == len(ids) and (shard.ids() == ids).all()
    for start, stop in ((0, 1), (17, 4000), (9_999, 10_001), (len(ids) - 3, len(ids) + 5), (50, 50)):
        assert (shard.ids(max(0, start), stop) == ids[max(0, start) : stop]).all()
    if kind in ("words", "one"):
        assert len(sequence) + 2 * len(rules) < 0.6 * len(ids)


def test_simhash(spark, docs):
    stamped = simhash.fingerprints(docs)
    got = {r["fp"]: (r["component_id"], r["key"]) for r in simhash.classes(stamped).collect()}
    prints = defaultdict(list)
    for doc_id, text in rows_of(docs):
        prints[simhash.fingerprint(text.encode())].append(doc_id)
    assert len(got) == len(prints)
    kept = simhash.keep(docs)
    assert kept.columns == docs.columns
    heads = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert Counter(heads) == Counter(head for head, _ in set(got.values()))


def test_simhash_links_across_cells_and_tiles(spark):
    """Chains of near fingerprints, with tiles so small that every cell needs several."""
    random = np.random.default_rng(5)
    prints = {int(x) for x in random.integers(0, 2**63, 300, np.uint64)}
    for x in list(prints)[:40]:
        for _ in range(12):
            x ^= int(np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 64, 2).astype(np.uint64)))
            prints.add(x)
    found = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(found[:, None] ^ found[None, :]) <= 3
    name = np.arange(len(found))
    while True:
        lower = np.where(near, name[None, :], len(found)).min(1)
        if (lower == name).all():
            break
        name = lower
    distinct = spark.createDataFrame([(int(x),) for x in found.view(np.int64)], "fp long").repartition(4)
    from lodeworks.llm.components import components

    edges = simhash.links(distinct, tile=2)
    assert edges.count() < near.sum()
    place = {int(x): i for i, x in enumerate(found.view(np.int64))}
    groups = defaultdict(set)
    for r in components(edges).collect():
        groups[r["component"]].add(place[r["node"]])
    expected = defaultdict(set)
    for i, n in enumerate(name):
        expected[n].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_forest_of_a_dense_tile():
    tile = np.arange(2**11, dtype=np.uint64)
    edges = simhash.forest(tile, tile, 3)
    assert len(edges) == len(tile) - 1 and len({b for _, b in edges}) == len(edges)


def test_bpe(spark, docs):
    got = bpe.digests(docs, *bpe.vocabulary()).collect()
    expected = Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows_of(docs))
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in got) == expected


def test_bpe_encodes_and_decodes_apart(spark, docs):
    vocabulary = bpe.vocabulary()
    apart = bpe.decode(bpe.encode(docs, *vocabulary), *vocabulary).collect()
    assert Counter(apart) == Counter(bpe.round_trip(docs, *vocabulary).collect())
    assert Counter((r["doc_id"], bytes(r["body"]).decode()) for r in apart) == Counter(rows_of(docs))


def test_bpe_of_long_pieces():
    import tiktoken

    path, pattern = bpe.vocabulary()
    mine = bpe.Encoder(path, pattern)
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=mine.ranks, special_tokens={})
    random = np.random.default_rng(2)
    pieces = ["aaaa" * 5000, "ab" * 3000, "=-" * 4000, "".join(map(chr, random.integers(97, 123, 20_000)))]
    pieces += ["".join(map(chr, random.choice([32, 10, 39, 65, 233, 0x4E2D, 0x1F600, 0x85, 0x1C, 0xA0, 48], 30))) for _ in range(500)]
    for piece in pieces:
        packed = mine.encode(piece)
        assert np.frombuffer(packed, "<u4").tolist() == theirs.encode_ordinary(piece)
        assert mine.decode(packed) == piece.encode()


def test_mixing(spark, docs):
    names = docs.columns
    planned = mixing.plan(docs)
    got = planned.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows_of(docs))
    assert all(r["__size"] == len((r["text"] or "").split()) and r["__taken"] <= 3 * r["__size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["__taken"]
        target[r["source"]] = r["__target"]
    assert all(abs(taken[s] - t) <= 0.51 for s, t in target.items())
    order = mixing.training_order(docs)
    assert order.columns == names
    order.collect()


def test_targets_stop_at_three_times_the_size(spark):
    sizes = [("a", 10), ("b", 500), ("c", 400), ("d", 0), (None, 90)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    # By name a, b, c, d, null weigh 5, 2, 1, 5, 2. a stops at 30, d at 0, null at 270; b and c share the other 700.
    assert got == {"a": 30, "d": 0, None: 270, "b": pytest.approx(1400 / 3), "c": pytest.approx(700 / 3)}


def test_positions_follow_the_schedules(spark):
    rows = [(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    early = defaultdict(list)
    for r in mixing.plan(docs).collect():
        for words, position in (tuple(t) for t in r["__turns"]):
            assert 0 <= position <= 1
            early[r["source"]].append((position, words))
    share = {s: sum(w for p, w in v if p < 0.5) / sum(w for _, w in v) for s, v in early.items()}
    # Over the first half of the time the integrals of the schedules are 0.625, 0.5 and 0.375.
    assert all(abs(share[s] - x) < 0.01 for s, x in zip("abc", (0.625, 0.5, 0.375)))


def test_winnowing(spark, docs):
    rows = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0]), reverse=True)
    got = winnowing.with_next(docs)
    found = got.select("id", "body", "next_body", winnowing.written_out(got["found"]).alias("print")).collect()
    assert Counter((r["id"], r["body"]) for r in found) == Counter(rows)
    assert Counter(r["next_body"] for r in found) == Counter(t for _, t in rows)
    for r in found:
        assert r["print"] == " ".join(f"{h:X}:{p}" for h, p in _winnowed(r["body"]))


def test_winnowing_shares_a_hash_of_every_long_passage():
    random = np.random.default_rng(4)
    shared = [f"w{i}" for i in random.integers(0, 9**6, 12)]
    for _ in range(20):
        a, b = ([f"x{i}" for i in random.integers(0, 9**6, 40)] for _ in range(2))
        prints = [{h for h, _ in _winnowed(" ".join(t[:20] + shared + t[20:]))} for t in (a, b)]
        assert prints[0] & prints[1]


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://Sub.Example.ORG/es/x?y#z", "x://example.org/en/12", "x://com/fr/",
        "x://acom/fr/1", "x://a.com/de/#q://b.org/", "x://casino-win.example.net/en/1?u=http://b.org/", "x://" + "a" * 9000 + "/" + "b" * 9000,
        "x://org", "x://a.example.org/fr/?es/",
    ]
    rows = [(i, u, "h", "p", "r", "v") for i, u in enumerate(urls)] * 2
    model = url_filter.Model(url_filter.labelled_urls())
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string, verdict string")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judged(pages, model).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("", "", None, "allow")
    assert got[4] == ("sub.example.org", "/es/x", "example.org/es/", "block")
    assert got[5][2:] == ("example.org/en/1", "block") and got[6][2:] == ("com/fr/", "allow")
    assert got[7][2] is None and got[8] == ("a.com", "/de/", "com/de/", "block")
    assert got[9] == ("casino-win.example.net", "/en/1", None, "block")
    assert got[10][2] is None and got[11] == ("org", "", None, got[11][3]) and got[12][2:] == ("org/", "allow")
    assert url_filter.judged(pages.limit(0), model).count() == 0
    assert url_filter.Model([]).margin("a", "/") < 0 < url_filter.Model([("a", "/", 1)]).margin("b", "/")


def test_language_model(spark, docs, monkeypatch):
    body = docs.select(docs["doc_id"].alias("id"), text_of().cast("binary").alias("body"))
    counts = language_model.count_words(body)
    known = Counter(t for _, x in rows_of(docs) for t in language_model.tokens(x.encode()))
    assert {bytes(r["word"]): r["n"] for r in counts.collect()} == known
    # So few words are sent to the tasks that most go the other way.
    for most in (language_model.KNOWN, 3):
        monkeypatch.setattr(language_model, "KNOWN", most)
        words = language_model.vocabulary(counts)
        model = language_model.train(body, words)
        got = language_model.scored(body, counts, words, model).collect()
        assert Counter((r["id"], r["n_tokens"], r["n_known"]) for r in got) == Counter(
            (i, len(language_model.tokens(t.encode())), len(language_model.tokens(t.encode()))) for i, t in rows_of(docs)
        )
        total, distinct = sum(known.values()), len(known)
        base = {
            (i, n): sum(math.log10((known[w] + 1) / (total + distinct + 1)) for w in found)
            for i, n, found in ((i, len(language_model.tokens(t.encode())), language_model.tokens(t.encode())) for i, t in rows_of(docs))
        }
        for r in got:
            if r["id"] != 11:  # two texts of one id
                assert r["base_score"] == pytest.approx(base[r["id"], r["n_tokens"]])


def _small_corpus(spark):
    rows = [(i, f"the w{i % 40} of a thing{i % 7} and x{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "cast(text AS binary) AS body")
    return rows, docs, language_model.count_words(docs)


def test_probabilities_sum_to_one(spark):
    _, docs, counts = _small_corpus(spark)
    words = language_model.vocabulary(counts)
    model, wide = language_model.train(docs, words), words.wide
    sums, every = model.sums(), np.arange(wide)
    for last, before in ((3, 5), (wide, wide), (wide - 20, 1)):
        events = np.exp(model.scores(np.full(wide, before), np.full(wide, last), every) - sums[before, last])
        assert events.sum() == pytest.approx(1, abs=1e-4)
    # Within a class, the known words and one unknown.
    for event in range(wide - wide // 2, wide):
        tokens, many = words.event_tokens[event], words.event_words[event]
        inside = [words.count[at] for w, at in words.words.items() if words.event[at] == event]
        assert (sum(c + 1 for c in inside) + 1) / (tokens + many + 1) == pytest.approx(1)


def test_scores_are_plain_sums(spark, monkeypatch):
    """Every score against one worked out token by token in doubles, with words that come by the join too."""
    rows, docs, counts = _small_corpus(spark)
    monkeypatch.setattr(language_model, "KNOWN", 20)
    words = language_model.vocabulary(counts)
    model, wide = language_model.train(docs, words), words.wide
    known = {bytes(r["word"]): r["n"] for r in counts.collect()}
    far, near, out, bias = (np.float64(x) for x in (model.far, model.near, model.out, model.bias))
    own = {w: int(words.event[at]) for w, at in words.words.items() if words.event[at] < wide - wide // 2}
    classes = {w: language_model.class_of(w, wide) for w in known if w not in own}
    others = [(4000, "the unseen words of w3"), (4001, "")]
    both = docs.unionByName(spark.createDataFrame(others, "id long, text string").selectExpr("id", "cast(text AS binary) AS body"))
    got = {r["id"]: r["score"] for r in language_model.scored(both, counts, words, model).collect()}
    assert len(got) == len(rows) + 2
    for i, text in [*rows[::17], *others]:
        before, last, score = wide, wide, 0.0
        for word in language_model.tokens(text.encode()):
            event = own.get(word, language_model.class_of(word, wide))
            each = out @ (far[before] + near[last]) + bias
            score += each[event] / math.log(10) - math.log10(np.exp(each).sum())
            if word not in own:
                inside = [known[w] for w, c in classes.items() if c == event]
                score += math.log10((known.get(word, 0) + 1) / (sum(inside) + len(inside) + 1))
            before, last = last, event
        assert got[i] == pytest.approx(score, rel=1e-4)


def test_the_model_does_not_depend_on_partitions_and_grows(spark):
    assert [language_model.events_of(n) for n in (0, 1 << 21, 1 << 27)] == [128, 1024, 2048]
    _, docs, counts = _small_corpus(spark)
    words = language_model.vocabulary(counts)
    flats = [language_model.train(docs.repartition(n), words, part).flat for part in (1 << 22, 600) for n in (1, 4, 64)]
    for one, same in ((0, 1), (0, 2), (3, 4), (3, 5)):
        assert np.allclose(flats[one], flats[same], atol=1e-5)
    assert not np.allclose(flats[0], flats[3], atol=1e-5)  # four parts, averaged


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(8, 1), (4, 0), (5, 0), (6, 1), (None, 1), (9, None), (8, 0)]])
def test_toxicity(spark, docs, labels):
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.scored(docs, model, *docs.columns)
    assert got.columns == [*docs.columns, "__score"]
    scores = got.collect()
    assert Counter(r["doc_id"] for r in scores) == Counter(i for i, _ in rows_of(docs))
    assert all(0 <= r[-1] <= 1 for r in scores)  # the input has a column of this name too
    kept = toxicity.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r[-1] < 0.5 for r in scores)


def test_isotonic_is_monotone_and_fits():
    at, share = toxicity.isotonic(np.array([0.0, 1, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1, 1]))
    assert (np.diff(share) >= 0).all() and (np.diff(at) >= 0).all()
    assert np.interp([0, 1.5, 4], at, share).tolist() == [0, 0.5, 1]


def test_ids_of_the_whole_range(spark):
    """Exact dedup and fingerprints where the difference of two ids is no long."""
    rng = np.random.default_rng(1)
    ids = [-(2**63), -(2**63) + 5, 2**63 - 10, 2**63 - 1, 0, *rng.integers(-(2**63), 2**63 - 1, 60).tolist(), *range(2**62, 2**62 + 40)]
    texts = {i: f"{i % 7} " + "some words that all of them have and a few of their own such as these ones " * (1 + i % 3) for i in ids}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = {r["id"]: r for r in winnowing.with_next(docs).collect()}
    order = sorted(texts, reverse=True)
    assert len(rows) == len(texts)
    assert all(rows[i]["next_body"] == texts[j] for i, j in zip(order, [*order[1:], order[0]]))


def test_ranges_of_uneven_ids(spark):
    """A dense block and an outlier: ranges hold about as many rows each."""
    ids = [*range(400), 2**61]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    keyed = docs.select(docs["doc_id"].alias("id"))
    borders = winnowing._borders(keyed)
    placed = keyed.select("id", winnowing._range(keyed["id"], borders).alias("range")).collect()
    assert all(r["range"] == sum(b <= r["id"] for b in borders) for r in placed)
    assert max(Counter(r["range"] for r in placed).values()) <= 60
    many = sorted({int(x) for x in np.random.default_rng(2).integers(0, 2**40, 300)})
    wide = spark.range(400).selectExpr("id * 2500000000 AS id")
    placed = wide.select("id", winnowing._range(wide["id"], many).alias("range")).collect()
    assert all(r["range"] == sum(b <= r["id"] for b in many) for r in placed)


@pytest.mark.parametrize("text,least", [
    ("".join(chr(0x4E00 + (i * i * 37 + 11 * i) % 5000) for i in range(300)), 0.4), ("six words are not very many", 0.01),
])
def test_fingerprints_of_texts_without_many_words(spark, text, least):
    """Two thirds are shared: of a long text most chosen grams; of a short one, one at least."""
    edited = text[: len(text) - len(text) // 3] + "x" * (len(text) // 3)
    df = spark.createDataFrame([(text, edited)], "a string, b string")
    found = df.select(winnowing.winnow(df["a"]).alias("a"), winnowing.winnow(df["b"]).alias("b"))
    near = found.select(winnowing.likeness(found["a"], found["b"]).alias("near")).first()["near"]
    assert near >= least
