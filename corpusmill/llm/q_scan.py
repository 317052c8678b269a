"""Checked queries: personal data and secrets."""

from __future__ import annotations

from corpusmill.llm import pii, secrets
from corpusmill.llm.common import read
from corpusmill.llm.registry import register


@register("op1_pii")
def op1(spark, sf_dir):
    return pii.digest_columns(pii.find_pii(read(spark, sf_dir, "documents", "doc_id", "text")))


@register("op10_secrets")
def op10(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return secrets.digest_columns(secrets.scan_secrets(docs))
