"""Checked queries: exact dedup, n-gram join, repeated passages."""

from __future__ import annotations

from corpusmill.llm import exact_dedup, ngram_join, repeats
from corpusmill.llm.common import read
from corpusmill.llm.registry import register

SQL9 = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM n
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""


@register("op9_exact_dedup", SQL9)
def op9(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents", "doc_id", "text"), hash_all=True)


@register("op4_ngram_join")
def op4(spark, sf_dir):
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))


@register("op7_substring_dedup")
def op7(spark, sf_dir):
    return repeats.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
