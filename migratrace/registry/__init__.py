"""Named queries over the test tables, each with the SQL that checks it."""

from __future__ import annotations

from functools import wraps

from migratrace.registry import (
    q_catalog,
    q_classify,
    q_density,
    q_generate,
    q_metrics,
    q_normalize,
    q_profile,
    q_reports,
    q_retrieve,
    q_sources,
    q_text,
)
from migratrace.session import ship_package

MODULES = (
    q_classify,
    q_normalize,
    q_text,
    q_catalog,
    q_density,
    q_metrics,
    q_reports,
    q_generate,
    q_retrieve,
    q_profile,
    q_sources,
)


def _shipped(query):
    @wraps(query)
    def run(spark, folder):
        ship_package(spark)
        return query(spark, folder)

    return run


def all_queries() -> dict:
    return {name: _shipped(fn) for m in MODULES for name, fn in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
