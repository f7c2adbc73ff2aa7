"""Registered queries: one per operator key, each ``(spark, sf_dir) ->
DataFrame`` over the whole driver tables, with a DuckDB oracle text where the
operator is SQL-expressible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every catalog module (each registers on import)."""
    from inkwell.plans.catalog import (composite, entities, evaluation,  # noqa: F401
                                       fields, labels, models, sources, text, vectors)
