"""Named queries over the benchmark tables, one or more per operator."""

from __future__ import annotations

from importlib import import_module

from showroom.queries.registry import QUERIES, SQL, Query

MODULES = [
    "join_queries", "contract_queries", "feature_queries", "mask_queries", "profile_queries", "split_queries",
    "rating_queries", "metric_queries", "model_queries",
    "closed_form_queries", "statistics_queries",
]


def _load() -> None:
    for name in MODULES:
        import_module(f"showroom.queries.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
