"""All core queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mentionmill.plans import corpus, events, examples, graphs, links, mentions, records

_MODULES = (mentions, links, graphs, corpus, events, records, examples)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.SQL.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The typed entity graph: qualifying relations of all models, one edge per pair of entities."""
    return graphs.typed_edges(spark, d)
