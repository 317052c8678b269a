"""Checked query: the whole pipeline."""

from __future__ import annotations

import corpus_pipeline
from corpusmill.llm.registry import ORACLE, register

register("pipeline")(corpus_pipeline.run)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
