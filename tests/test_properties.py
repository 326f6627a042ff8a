"""Generated inputs against plain Python."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodeworks.operators import quality
from lodeworks.sinks import writers
from lodeworks.sinks.writers import write_dataset
from lodeworks.sources import readers
from lodeworks.sources.readers import read_source
from lodeworks.storage import work_folder
from tests.conftest import rows

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

names = st.lists(st.text("ab.`' \\é", min_size=1, max_size=6).filter(str.strip), min_size=1, max_size=4, unique_by=str.lower)


@FEW
@given(names=names, data=st.data())
def test_quality_matches_plain_python(spark, names, data):
    width = len(names)
    cells = st.lists(st.tuples(*[st.one_of(st.none(), st.integers(0, 3))] * width), max_size=8)
    table = [(i, *row) for i, row in enumerate(data.draw(cells))]
    schema = ", ".join(["`bronze_row` int"] + [f"`{n.replace('`', '``')}` int" for n in names])
    df = spark.createDataFrame(table, schema)

    def issues(row):
        return ", ".join(f"Null value in {n}" for n, v in zip(names, row[1:]) if v is None) or None

    expected = [(*row, issues(row)) for row in table]
    valid, invalid = quality.split(df)
    assert rows(quality.annotate(df)) == _sorted(expected)
    assert rows(valid) == _sorted([r[:-1] for r in expected if r[-1] is None])
    assert rows(invalid) == _sorted([r for r in expected if r[-1] is not None])
    failed = [(r[0], n, "not_null") for r in table for n, v in zip(names, r[1:]) if v is None]
    assert rows(quality.violations(df, ["bronze_row"])) == _sorted(failed)
    assert quality.summary(df).first() == (len(table), valid.count(), invalid.count())


texts = st.text(st.sampled_from('a,"\\\'\n\r\t é ;N|#'), max_size=8).filter(lambda s: s != "\\N")


@FEW
@given(cells=st.lists(st.tuples(st.one_of(st.none(), texts), st.one_of(st.none(), texts)), min_size=1, max_size=12))
def test_text_formats_keep_any_text(spark, cells):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, a string, b string").coalesce(1)
    for fmt, write, read in (("csv", None, None), ("json", None, None)):
        path = work_folder(spark, "text")
        write_dataset(df, path, fmt, options=write)
        assert rows(read_source(spark, fmt, path, read, df.schema)) == rows(df)


def _sorted(records):
    return sorted(records, key=lambda t: [(v is None, str(v)) for v in t])
