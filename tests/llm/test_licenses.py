"""Canonical forms of texts and of their lines, made in one pass."""

from __future__ import annotations

from lodeworks.llm import licenses


def test_texts_are_brought_to_their_forms_once(spark, tmp_path):
    """What comes after the one pass reads digests only: no pattern and no text is left in the plan."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "prose\nReleased under the MIT licence")], "doc_id long, text string").write.parquet(path)
    got = licenses.scan(spark.read.parquet(path))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and "regexp_replace" not in plan and "translate" not in plan
    assert [(r["notices"], r["n_notices"]) for r in got.collect()] == [("MIT", 1)]


def test_more_rows_than_are_taken_at_a_time(spark):
    """Each with its own text, letters of several bytes and null among them."""
    rows = [(i, None if i % 7 == 0 else f"é{'—' * (i % 5)}{i}\n# Licensed under CC BY 4.0.\n{i % 3}") for i in range(3 * licenses.ROWS + 1)]
    known = [*licenses.KNOWN, ("of 500", "é500\nlicenced under CC-BY 4.0\n2"), ("nothing", "(c)")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in licenses.scan(docs, known).collect()}
    assert sorted(got) == [i for i, _ in rows]
    assert all(r["notices"] == ("CC-BY-4.0" if i % 7 else "") and r["n_notices"] == (i % 7 > 0) for i, r in got.items())
    assert {i for i, r in got.items() if r["license"]} == {500}


def test_spellings_over_lines_and_holders_in_lines():
    known = ["All rights\nreserved", "x gnu\n\n gpl", "Copyright (c) 2020 me\r\nkeep\r\n(c) 2021 you", "a - sub\tLicence", "a  per. cent per cent"]
    assert licenses.canonical(known) == [
        "", "x gnu general public license", "keep", "a sublicense", "a percent percent"
    ]
    lists = licenses._lines(licenses._cleaned(licenses.pa.array(known)))
    lines = [[x.strip() for x in some if x.strip()] for some in lists.to_pylist()]
    assert lines[:3] == [["all rights", "reserved"], ["x gnu", "gpl"], ["keep"]]
