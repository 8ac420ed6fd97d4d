"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, an oracle SQL string for DuckDB."""

from __future__ import annotations

import functools
from collections.abc import Callable

from cartwheel.session import ship_package

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship_package(spark)  # executors import cartwheel for Python UDFs
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module so its queries register themselves."""
    from cartwheel.plans import (catalog_recs, catalog_clean, catalog_features,  # noqa: F401
                                 catalog_quality, catalog_explore, catalog_baskets,
                                 catalog_eval, catalog_factors, catalog_text,
                                 catalog_vectors, catalog_stream, catalog_flows, catalog_store)
