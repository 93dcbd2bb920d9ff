"""All queries and their check SQL."""

from __future__ import annotations

from unirec.plans import (
    coverage_queries, discovery_queries, event_queries, mapping_queries, merge_queries, scan_queries, sink_queries, stream_queries, upkeep_queries,
)

MODULES = (
    event_queries, mapping_queries, merge_queries, scan_queries, discovery_queries, sink_queries, stream_queries, coverage_queries, upkeep_queries,
)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
