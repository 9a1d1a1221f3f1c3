"""All registered queries of the library and their SQL twins, gathered from the modules of this folder."""

from __future__ import annotations

from . import queries_analysis, queries_control, queries_dataset, queries_match, queries_passes, queries_retry, queries_state, queries_web

PARTS = [m.C for m in (queries_dataset, queries_web, queries_state, queries_analysis, queries_match, queries_retry, queries_control, queries_passes)]
QUERIES = {name: f for part in PARTS for name, f in part.queries.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.oracles.items()}
