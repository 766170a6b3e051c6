"""Independent SQL for the named queries, over the raw tables."""

from __future__ import annotations

from oracle import aggregates, attribution, monitoring, ranking, silver


def all_sql() -> dict[str, str]:
    merged: dict[str, str] = {}
    for module in (silver, aggregates, ranking, monitoring, attribution):
        merged.update(module.SQL)
    return merged
