"""Row-level quality: annotate, split, count, report.

Every check is one flat predicate per column, so the plan grows linearly with the number of
columns. All operators here are narrow: no shuffle except the final merge of counters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.columns import named, quoted, sql_text

# Fixed values that readers of the outputs match on: these names, and the issue text
# "Null value in <column>" joined by ", ".
ISSUES = "data_quality_issues"
RESERVED_PREFIXES = ("bronze_", "silver_")
NOT_NULL = "not_null"

_VIOLATIONS = "array<struct<failed_column:string,rule:string>>"


@dataclass(frozen=True)
class Rule:
    """A caller's check (Q6): rows where ``violated`` is true get ``message``; NULL is no violation.

    ``violated`` is a Column or SQL text; ``column`` names the column at fault, if one is.
    """

    message: str
    violated: Column | str
    column: str | None = None

    def broken(self) -> Column:
        test = F.expr(self.violated) if isinstance(self.violated, str) else self.violated
        return F.coalesce(test, F.lit(False))


def business_columns(df: DataFrame) -> list[str]:
    """the columns under quality control; lineage and issue columns are exempt."""
    return [c for c in df.columns if c != ISSUES and not c.startswith(RESERVED_PREFIXES)]


def _each_null(df: DataFrame, form: str) -> list[str]:
    """``form`` filled in per checked column. SQL text keeps thousands of columns one JVM call."""
    return [
        form.format(column=quoted(c), name=sql_text(c), message=sql_text(f"Null value in {c}"))
        for c in business_columns(df)
    ]


def is_invalid(df: DataFrame, rules: Sequence[Rule] = ()) -> Column:
    """True for rows with at least one violation.

    The ``IS NULL OR ...`` form reaches the file scan, so a read of invalid rows skips row
    groups whose statistics show no NULL.
    """
    tests = _each_null(df, "{column} IS NULL")
    bad = F.expr(" OR ".join(tests)) if tests else F.lit(False)
    for rule in rules:
        bad = bad | rule.broken()
    return bad


def is_valid(df: DataFrame, rules: Sequence[Rule] = ()) -> Column:
    """Complement of `is_invalid`, spelled as a conjunction for pushdown."""
    tests = _each_null(df, "{column} IS NOT NULL")
    good = F.expr(" AND ".join(tests)) if tests else F.lit(True)
    for rule in rules:
        good = good & ~rule.broken()
    return good


def annotate(df: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """Q1: add ``data_quality_issues``, the messages in column order, NULL for clean rows."""
    notes = _each_null(df, "CASE WHEN {column} IS NULL THEN {message} END")
    parts = [F.expr(f"concat_ws(', ', {', '.join(notes)})")] if notes else []
    if rules:
        parts = [F.nullif(p, F.lit("")) for p in parts]
        parts = [F.concat_ws(", ", *parts, *[F.when(r.broken(), F.lit(r.message)) for r in rules])]
    text = F.nullif(parts[0], F.lit("")) if parts else F.lit(None).cast("string")
    return df.withColumn(ISSUES, text)


def valid_rows(df: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """F2, P5: clean rows, without the issue column."""
    return df.filter(is_valid(df, rules)).drop(ISSUES)


def invalid_rows(df: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """quarantined rows with their issues."""
    return annotate(df.filter(is_invalid(df, rules)), rules)


def split(df: DataFrame, rules: Sequence[Rule] = ()) -> tuple[DataFrame, DataFrame]:
    """Q2: (valid, invalid); disjoint, and together the whole input."""
    return valid_rows(df, rules), invalid_rows(df, rules)


def summary(df: DataFrame, rules: Sequence[Rule] = ()) -> DataFrame:
    """Q3: one row with ``total_rows, valid_rows, invalid_rows``, in one pass."""
    bad = is_invalid(df, rules)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("invalid_rows"),
    )


def violations(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule] = ()) -> DataFrame:
    """Q5: one row per failed check: the keys, ``failed_column`` and ``rule``.

    Clean rows are filtered first, at the scan where possible, so only invalid rows pay for
    the per-column array.
    """
    form = "CASE WHEN {column} IS NULL THEN named_struct('failed_column', {name}, 'rule', '" + NOT_NULL + "') END"
    failed = F.expr(f"array({', '.join(_each_null(df, form))})").cast(_VIOLATIONS)
    extra = [
        F.when(
            r.broken(),
            F.struct(F.lit(r.column).cast("string").alias("failed_column"), F.lit(r.message).alias("rule")),
        )
        for r in rules
    ]
    if extra:
        failed = F.concat(failed, F.array(*extra).cast(_VIOLATIONS))
    found = F.filter(failed, lambda v: v.isNotNull())
    return (
        df.filter(is_invalid(df, rules))
        .select(*[named(k) for k in keys], F.explode(found).alias("__v"))
        .select(*[named(k) for k in keys], "__v.failed_column", "__v.rule")
    )
