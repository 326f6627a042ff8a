"""J1-J4, U1 on hand-made frames, against brute force, and their physical plans."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from lodeworks.operators import merge as m
from tests.conftest import rows

DEST = "k int, v string, w int"
SRC = "k int, v string, w int, extra string, seq int"


@pytest.fixture
def dest(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 30)], DEST)


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [(1, "A", 7, "x", 1), (1, "AA", 8, "y", 2), (3, "C", 9, "z", 1), (3, "CC", 9, "z", 2), (None, None, 0, "q", 1)],
        SRC,
    )


def test_upsert(source, dest):
    got = m.merge(source, dest, ["k"], update_columns=["v"], order_by=["seq"])
    assert got.columns == ["k", "v", "w", "extra"]
    assert rows(got) == [
        (1, "AA", 10, None),
        (2, "b", 20, None),
        (3, "C", 9, "z"),
        (3, "CC", 9, "z"),
        (None, None, 30, None),
    ]
    assert m.merge_counts(source, dest, ["k"]).first() == (5, 3, 2)


def test_all_columns_by_default(source, dest):
    got = m.update_rows(source, dest, ["k"], order_by=["seq"])
    assert rows(got) == [(1, "AA", 8), (2, "b", 20), (None, None, 0)]


def test_every_duplicate_destination_row_is_updated(spark):
    dest = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], DEST)
    source = spark.createDataFrame([(1, "Z")], "k int, v string")
    assert rows(m.merge(source, dest, ["k"])) == [(1, "Z", 1), (1, "Z", 2)]


def test_ambiguous_match_needs_an_order(source, dest):
    with pytest.raises(PySparkException, match="ambiguous merge"):
        m.merge(source, dest, ["k"]).collect()


def test_duplicate_new_keys_are_not_ambiguous(spark, dest):
    source = spark.createDataFrame([(7, "x", 1), (7, "y", 2)], DEST)
    assert m.merge(source, dest, ["k"]).filter("k = 7").count() == 2


def test_missing_columns_are_null_and_types_stay(spark, dest):
    source = spark.createDataFrame([(9, "q")], "k bigint, v string")
    got = m.merge(source, dest, ["k"])
    assert got.schema["k"].dataType.simpleString() == "int"
    assert rows(got.filter("k = 9")) == [(9, "q", None)]


def test_order_column_of_the_destination_is_kept(spark):
    dest = spark.createDataFrame([(1, "a", 1)], "k int, v string, seq int")
    source = spark.createDataFrame([(1, "b", 2), (1, "c", 3), (2, "d", 9)], "k int, v string, seq int")
    assert rows(m.merge(source, dest, ["k"], order_by=["seq"])) == [(1, "c", 3), (2, "d", 9)]


def test_rerun_changes_nothing(spark, source, dest):
    updates = source.filter("k = 1 OR k IS NULL")
    once = m.update_rows(updates, dest, ["k"], order_by=["seq"])
    assert rows(m.update_rows(updates, once, ["k"], order_by=["seq"])) == rows(once)


def test_keys_among_the_update_columns(source, dest):
    got = m.merge(source, dest, ["k"], update_columns=["k", "v", "v", "extra", "seq"], order_by=["seq"])
    assert rows(got) == rows(m.merge(source, dest, ["k"], update_columns=["v"], order_by=["seq"]))


def test_keys_are_needed(source, dest):
    with pytest.raises(ValueError, match="key"):
        m.merge(source, dest, [])


def test_ties_fall_the_same_way(spark):
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "k int, v string, seq int")
    dest = spark.createDataFrame([(1, "z")], "k int, v string")
    assert rows(m.merge(source, dest, ["k"], order_by=["seq"])) == [(1, "b")]


def test_columns_without_an_order_travel_with_their_row(spark):
    source = spark.sql("SELECT * FROM VALUES (1, map('a', 1), 2, 1), (1, map('b', 2), 1, 2) t(k, m, w, seq)")
    dest = spark.sql("SELECT 1 AS k, map('z', 0) AS m, 0 AS w")
    got = m.merge(source, dest, ["k"], order_by=["seq"]).collect()
    assert [r.asDict() for r in got] == [{"k": 1, "m": {"b": 2}, "w": 1}]


def test_odd_column_names(spark):
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "`k.1` int, `v.``1` string, seq int")
    dest = spark.createDataFrame([(1, "a"), (2, "b")], "`k.1` int, `v.``1` string")
    assert rows(m.merge(source, dest, ["k.1"], order_by=["seq"])) == [(1, "y"), (2, "b")]


_key = st.one_of(st.none(), st.integers(0, 4))
_val = st.one_of(st.none(), st.sampled_from("abc"))


def _brute_force(source, dest):
    """(k, j, v, seq) rows into (k, j, v, w) rows."""
    best = {}
    for k, j, v, seq in source:
        rank = (seq, v is not None, v or "")
        if (k, j) not in best or rank > best[(k, j)][0]:
            best[(k, j)] = (rank, v)
    have = {(k, j) for k, j, *_ in dest}
    out = [(k, j, best[(k, j)][1] if (k, j) in best else v, w) for k, j, v, w in dest]
    return out + [(k, j, v, None) for k, j, v, _ in source if (k, j) not in have]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    source=st.lists(st.tuples(_key, _key, _val, st.integers(0, 3)), max_size=12),
    dest=st.lists(st.tuples(_key, _key, _val, st.integers(0, 9)), max_size=12),
)
def test_merge_matches_brute_force(spark, source, dest):
    s = spark.createDataFrame(source, "k int, j int, v string, seq int")
    d = spark.createDataFrame(dest, "k int, j int, v string, w int")
    got = m.merge(s, d, ["k", "j"], order_by=["seq"])
    order = lambda t: [(v is None, str(v)) for v in t]
    assert rows(got) == sorted(_brute_force(source, dest), key=order)
