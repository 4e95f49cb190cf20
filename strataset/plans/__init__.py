"""Queries over the benchmark tables: one per operator, each with its SQL where SQL can say it."""

from __future__ import annotations

from strataset.plans.registry import ORACLES, QUERIES, Query


def _load() -> None:
    from strataset.plans import (  # noqa: F401
        explore_queries,
        index_queries,
        project_queries,
        semantic_queries,
        storage_queries,
        term_queries,
        validate_queries,
    )


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
