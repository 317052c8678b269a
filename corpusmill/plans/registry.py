"""Registry of checked queries: a Spark callable and (usually) DuckDB SQL.

Each Spark query takes ``(spark, sf_dir)`` and reads the supplied tables;
each SQL string runs on DuckDB views with the same table names.  Column
names and types are aligned on both sides (bigint / double / string).
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
    import importlib
    for mod in MODULES:
        importlib.import_module(f"{__package__}.{mod}")


MODULES = ("queries_text", "queries_splits", "queries_pii", "queries_tokens", "queries_metrics", "queries_pretrain")
