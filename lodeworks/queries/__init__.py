"""Every operator as a named query over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from lodeworks.queries import files, flows, formats, merging, quality, runs, scans, stamps, tables
from lodeworks.queries.base import oracle_of, queries_of

_MODULES = (quality, merging, scans, formats, tables, stamps, files, runs, flows)

QUERIES = queries_of(_MODULES)
ORACLE = oracle_of(_MODULES)
