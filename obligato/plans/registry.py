"""Query registry: name -> (Spark builder, oracle SQL).

(spark, sf_dir) and returns a lazy DataFrame over the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries_core, queries_explore, queries_files, queries_links, queries_misc, queries_quality, queries_scalar, queries_sinks, queries_stats, queries_text  # noqa: F401
