"""The query catalogue: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; ``oracle`` is its DuckDB SQL twin (None: rows-only)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> tuple[dict[str, QueryFn], dict[str, str]]:
    """Import every registry module and return the catalogue."""
    from tracewise.plans import registry, registry_io, registry_model  # noqa: F401
    return QUERIES, ORACLES
