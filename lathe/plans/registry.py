"""Registry of named queries: each is ``fn(spark, sf_dir) -> DataFrame``
plus, where the result is SQL-expressible, an equivalent DuckDB query on
the same tables (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module (registration happens on import)."""
    from lathe.plans import (catalog_regression, catalog_profile, catalog_panel,  # noqa: F401
                             catalog_features, catalog_balance, catalog_evaluate,
                             catalog_text, catalog_models, catalog_flows)
