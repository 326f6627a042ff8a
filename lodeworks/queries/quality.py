"""Q1-Q6, F2-F4, P5."""

from __future__ import annotations

from lodeworks.operators import quality
from lodeworks.queries.base import DIRTY_COLUMNS, DIRTY_SQL, ISSUES_SQL, Registry, dirty

registry = Registry()

_DIRTY = f"WITH dirty AS ({DIRTY_SQL}) "
_RULE = quality.Rule("value below 5", "value < 5", "value")
_RULE_ISSUES = ISSUES_SQL.replace("), '')", ", CASE WHEN value < 5 THEN 'value below 5' END), '')")


@registry.query("dq_annotate", _DIRTY + f"SELECT *, {ISSUES_SQL} AS data_quality_issues FROM dirty")
def dq_annotate(spark, sf_dir):
    return quality.annotate(dirty(spark, sf_dir))


@registry.query("dq_valid_rows", _DIRTY + f"SELECT * FROM dirty WHERE {ISSUES_SQL} IS NULL")
def dq_valid_rows(spark, sf_dir):
    return quality.split(dirty(spark, sf_dir))[0]


@registry.query(
    "dq_invalid_rows",
    _DIRTY + f"SELECT *, {ISSUES_SQL} AS data_quality_issues FROM dirty WHERE {ISSUES_SQL} IS NOT NULL",
)
def dq_invalid_rows(spark, sf_dir):
    return quality.split(dirty(spark, sf_dir))[1]


@registry.query(
    "dq_summary",
    _DIRTY
    + f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE {ISSUES_SQL} IS NULL) AS valid_rows,
                 count(*) FILTER (WHERE {ISSUES_SQL} IS NOT NULL) AS invalid_rows FROM dirty""",
)
def dq_summary(spark, sf_dir):
    return quality.summary(dirty(spark, sf_dir))


@registry.query(
    "dq_violations",
    _DIRTY
    + " UNION ALL ".join(
        f"SELECT event_id, '{c}' AS failed_column, 'not_null' AS rule FROM dirty WHERE {c} IS NULL"
        for c in DIRTY_COLUMNS
    ),
)
def dq_violations(spark, sf_dir):
    return quality.violations(dirty(spark, sf_dir), ["event_id"])


@registry.query("dq_custom_rules", _DIRTY + f"SELECT *, {_RULE_ISSUES} AS data_quality_issues FROM dirty")
def dq_custom_rules(spark, sf_dir):
    return quality.annotate(dirty(spark, sf_dir), [_RULE])


@registry.query(
    "dq_custom_violations",
    _DIRTY
    + " UNION ALL ".join(
        f"SELECT event_id, '{c}' AS failed_column, 'not_null' AS rule FROM dirty WHERE {c} IS NULL"
        for c in DIRTY_COLUMNS
    )
    + " UNION ALL SELECT event_id, 'value', 'value below 5' FROM dirty WHERE value < 5",
)
def dq_custom_violations(spark, sf_dir):
    return quality.violations(dirty(spark, sf_dir), ["event_id"], [_RULE])
