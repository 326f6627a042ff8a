"""Rows without an id beside copies that have one."""

from __future__ import annotations

from lodeworks.llm import simhash


def test_a_null_id_names_no_component(spark):
    rows = [(None, "one two three four"), (9, "one two three four"), (7, "One two three four"), (None, "quite another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stamped = simhash.fingerprints(docs)
    named = stamped.join(simhash.classes(stamped).drop("key"), "fp")
    got = [(r["id"], r["component_id"]) for r in named.select("id", "component_id").collect()]
    assert sorted(got, key=str) == sorted([(None, 7), (9, 7), (7, 7), (None, None)], key=str)
    assert sorted(map(str, (r[0] for r in simhash.keep(docs).select("doc_id").collect()))) == ["7", "None"]
