"""Checked queries for text cleaning and sentence extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import posexplode_rows
from ..operators import sentences as S
from ..sources.tables import table, text_table
from . import oracle_text as O
from .registry import register


def _docs(spark, sf_dir, *cols):
    if "text" in cols and "doc_id" in cols:
        return text_table(spark, sf_dir, "documents", "doc_id", *cols)
    return table(spark, sf_dir, "documents", *cols)


@register("ascii_strip", f"""
SELECT doc_id, {O.ascii_strip('text')} AS text FROM documents""")
def q_ascii_strip(spark, sf_dir):
    return _docs(spark, sf_dir, "doc_id", "text").select(
        "doc_id", T.ascii_strip("text").alias("text"))


@register("collapse_spaces", f"""
SELECT doc_id, {O.collapse('text')} AS text FROM documents""")
def q_collapse_spaces(spark, sf_dir):
    return _docs(spark, sf_dir, "doc_id", "text").select(
        "doc_id", T.collapse_spaces("text").alias("text"))


@register("transliterate", f"""
SELECT doc_id, {O.clean('text', True)} AS text FROM documents""")
def q_transliterate(spark, sf_dir):
    return _docs(spark, sf_dir, "doc_id", "text").select(
        "doc_id", T.clean_ascii("text", use_transliteration=True).alias("text"))


@register("extract_lines", f"""
WITH l AS (SELECT doc_id, {O.lines(O.clean('text'))} AS ls FROM documents)
SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_idx,
       unnest(ls) AS line
FROM l""")
def q_extract_lines(spark, sf_dir):
    return (posexplode_rows(_docs(spark, sf_dir, "doc_id", "text"), ["doc_id"],
                            T.extract_lines(T.clean_ascii("text")), "line_idx", "line")
            .withColumn("line_idx", F.col("line_idx").cast("bigint")))


@register("sentences", f"""
WITH s AS (SELECT doc_id AS article_id, {O.sentences('text')} AS sents FROM documents)
SELECT article_id, CAST(generate_subscripts(sents, 1) - 1 AS BIGINT) AS sent_idx,
       unnest(sents) AS text
FROM s""")
def q_sentences(spark, sf_dir):
    arts = S.articles_from_documents(_docs(spark, sf_dir, "doc_id", "source", "text"))
    return S.sentences(arts, None, None)


@register("sentence_filter", f"""
WITH s AS (SELECT doc_id AS article_id, {O.kept_sentences('text', 5, 200)} AS sents
           FROM documents)
SELECT article_id, CAST(generate_subscripts(sents, 1) - 1 AS BIGINT) AS sent_idx,
       unnest(sents) AS text
FROM s""")
def q_sentence_filter(spark, sf_dir):
    arts = S.articles_from_documents(_docs(spark, sf_dir, "doc_id", "source", "text"))
    return S.sentences(arts, 5, 200)


@register("article_sizes", f"""
SELECT doc_id AS article_id,
       CAST(len({O.kept_sentences('text')}) AS BIGINT) AS n_sent,
       {O.list_bytes(O.kept_sentences('text'))} AS size_bytes
FROM documents""")
def q_article_sizes(spark, sf_dir):
    arts = S.articles_from_documents(_docs(spark, sf_dir, "doc_id", "source", "text"))
    return S.sentence_arrays(arts).select("article_id", "n_sent", "size_bytes")


@register("lang_base", """
SELECT split_part(lang, '_', 1) AS lang, CAST(count(*) AS BIGINT) AS n_docs
FROM documents GROUP BY 1""")
def q_lang_base(spark, sf_dir):
    return (_docs(spark, sf_dir, "lang")
            .groupBy(T.lang_base("lang").alias("lang"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_docs")))
