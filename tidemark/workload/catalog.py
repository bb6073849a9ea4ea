"""All registered queries with their SQL twins."""

from __future__ import annotations

from tidemark.workload import features, runs, store, streams, texts

_GROUPS = (features, store, streams, texts, runs)

QUERIES = {name: fn for group in _GROUPS for name, fn in group.QUERIES.items()}
ORACLE = {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
