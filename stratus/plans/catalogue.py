"""The registered queries and the SQL that each must agree with."""

from __future__ import annotations

from stratus.plans import climate_queries, metric_queries, quality_queries, shape_queries, sink_queries, summary_queries, trend_queries  # noqa: F401  they register their queries
from stratus.plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
