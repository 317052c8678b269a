"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLE: dict = {}

MODULES = ("q_dedup", "q_scan", "q_layout", "q_text", "q_vectors", "q_manifest", "q_license", "q_pipeline")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"corpusmill.llm.{m}")
