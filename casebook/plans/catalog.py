"""All registered queries and their SQL answers."""

from __future__ import annotations

from casebook.plans import (  # noqa: F401
    queries_checks, queries_cleaning, queries_extract, queries_olap, queries_outcomes, queries_text, queries_warehouse,
)
from casebook.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
