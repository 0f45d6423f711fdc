"""SQL for the registered queries."""

from __future__ import annotations

from tidemark.plans.registry import sql


def oracle_sql() -> dict[str, str]:
    """One statement for each query that has one."""
    return sql()
