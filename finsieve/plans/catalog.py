"""All registered queries."""

from __future__ import annotations

from finsieve.plans import catalog_graph, catalog_monitoring, catalog_profile, catalog_ranking, catalog_roadmap  # noqa: F401
from finsieve.plans.registry import ORACLE, QUERIES, Run


def queries() -> dict[str, Run]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
