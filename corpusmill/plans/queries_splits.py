"""Checked queries for ordering, budgeted splits, caps and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as R
from ..operators import sentences as S
from ..sources.staging import stage
from ..sources.tables import table, text_table
from . import oracle_text as O
from .build_splits import WHOLE_SHARES, build_splits
from .registry import register

SEED = 0
EVAL_CAP = 1000      # the reference's evaluation cap in testing mode
SAMPLE_K = 10


def _articles(spark, sf_dir):
    return S.articles_from_documents(
        text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "source", "text"))


def _build(spark, sf_dir):
    return build_splits(_articles(spark, sf_dir), None, True, SEED, 5, 200, shares=WHOLE_SHARES)


# ----------------------------------------------------------------- oracle SQL
def _positions_sql(seed: int = SEED) -> str:
    kept = O.kept_sentences("text", 5, 200)
    return f"""
s AS (SELECT doc_id AS article_id, source AS title, doc_id AS dataset_id, {kept} AS sents
      FROM documents),
z AS (SELECT *, CAST(len(sents) AS BIGINT) AS n_sent, {O.list_bytes('sents')} AS size_bytes,
             md5('{seed}:' || CAST(article_id AS VARCHAR)) AS k FROM s),
p AS (SELECT *, CAST(row_number() OVER (ORDER BY k, article_id) - 1 AS BIGINT) AS seq,
             CAST(sum(size_bytes) OVER (ORDER BY k, article_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum FROM z),
q AS (SELECT *, cum - size_bytes AS before FROM p)"""


def _limit(share: float) -> str:
    """A share of all kept bytes, as the builder computes it."""
    return f"{share!r}::DOUBLE * (SELECT coalesce(sum(size_bytes), 0) FROM q)"


def _split_sql(budgets=None) -> str:
    """Splits by budgets in MiB or, without, by the shares of the whole table."""
    limits = ([f"{float(mib) * R.MIB!r}" for mib in budgets.values()] if budgets
              else [_limit(x) for x in WHOLE_SHARES.values()])
    ctes = [_positions_sql(), "b0 AS (SELECT CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS base)"]
    cases = []
    for i, (split, limit) in enumerate(zip(budgets or WHOLE_SHARES, limits)):
        ctes.append(f"e{i} AS (SELECT max(seq) AS hi, max(cum) AS nb FROM q, b{i} "
                    f"WHERE seq >= b{i}.lo AND before - b{i}.base <= {limit})")
        ctes.append(f"b{i + 1} AS (SELECT coalesce(e{i}.hi + 1, b{i}.lo) AS lo, "
                    f"coalesce(e{i}.nb, b{i}.base) AS base FROM b{i}, e{i})")
        cases.append(f"WHEN seq BETWEEN b{i}.lo AND e{i}.hi THEN '{split}'")
    frm = ", ".join(f"b{i}, e{i}" for i in range(len(limits)))
    ctes.append(f"lab AS (SELECT q.*, CASE {' '.join(cases)} END AS split FROM q, {frm})")
    ctes.append("m AS (SELECT * FROM lab WHERE split IS NOT NULL)")
    ctes.append("""d AS (SELECT split, article_id, seq,
                 CAST(generate_subscripts(sents, 1) - 1 AS BIGINT) AS sent_idx,
                 unnest(sents) AS text FROM m)""")
    return "WITH " + ",\n".join(ctes) + "\n"


# ----------------------------------------------------------------- queries
@register("seeded_shuffle", "WITH " + _positions_sql() + """
SELECT article_id, seq, size_bytes, before FROM q""")
def q_seeded_shuffle(spark, sf_dir):
    sized = stage(S.sentence_arrays(_articles(spark, sf_dir)).select("article_id", "size_bytes"), "sizes")
    return R.seeded_order(sized, "article_id", SEED, "size_bytes").select(
        "article_id", "seq", "size_bytes", "before")


@register("natural_order", "WITH " + _positions_sql() + """
SELECT article_id * article_id AS article_id,
       CAST(row_number() OVER (ORDER BY article_id) - 1 AS BIGINT) AS seq, size_bytes,
       CAST(sum(size_bytes) OVER (ORDER BY article_id) - size_bytes AS BIGINT) AS before FROM q""")
def q_natural_order(spark, sf_dir):
    """Ids with growing gaps, in their own order."""
    sized = stage(S.sentence_arrays(_articles(spark, sf_dir)).select(
        (F.col("article_id") * F.col("article_id")).alias("article_id"), "size_bytes"), "sizes")
    return R.seeded_order(sized, "article_id", None, "size_bytes").select(
        "article_id", "seq", "size_bytes", "before")


@register("budget_split", _split_sql() + "SELECT split, article_id, sent_idx, text FROM d")
def q_budget_split(spark, sf_dir):
    return _build(spark, sf_dir).sentences.select("split", "article_id", "sent_idx", "text")


@register("article_manifest", _split_sql() + """
SELECT article_id AS id, title, dataset_id, split, seq FROM m""")
def q_article_manifest(spark, sf_dir):
    return _build(spark, sf_dir).manifest


@register("split_sizes", _split_sql() + f"""
, bud AS ({" UNION ALL ".join(f"SELECT '{k}' AS split, CAST(floor({_limit(v)}) AS BIGINT) AS budget_bytes"
                           for k, v in WHOLE_SHARES.items())})
SELECT bud.split, CAST(coalesce(count(m.article_id), 0) AS BIGINT) AS n_articles,
       CAST(coalesce(sum(m.n_sent), 0) AS BIGINT) AS n_sentences,
       CAST(coalesce(sum(m.size_bytes), 0) AS BIGINT) AS size_bytes,
       CAST(bud.budget_bytes AS BIGINT) AS budget_bytes,
       round(coalesce(sum(m.size_bytes), 0) / bud.budget_bytes, 6) AS frac
FROM bud LEFT JOIN m ON m.split = bud.split
GROUP BY bud.split, bud.budget_bytes""")
def q_split_sizes(spark, sf_dir):
    return _build(spark, sf_dir).stats


@register("split_counts", _split_sql() + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM d GROUP BY split""")
def q_split_counts(spark, sf_dir):
    return (_build(spark, sf_dir).sentences.groupBy("split")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


@register("split_overlap", _split_sql() + f"""
, ids AS (SELECT article_id FROM d GROUP BY article_id
          HAVING count(DISTINCT split) = {len(WHOLE_SHARES)})
SELECT CAST(count(*) AS BIGINT) AS n_common FROM ids""")
def q_split_overlap(spark, sf_dir):
    data = _build(spark, sf_dir).sentences
    common = R.ids_in_all_splits(data, n_splits=len(WHOLE_SHARES))
    return common.agg(F.count(F.lit(1)).cast("bigint").alias("n_common"))


@register("cap_eval", _split_sql() + f"""
, r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY seq, sent_idx) AS rn FROM d)
SELECT split, article_id, sent_idx, text FROM r WHERE split = 'train' OR rn <= {EVAL_CAP}""")
def q_cap_eval(spark, sf_dir):
    data = _build(spark, sf_dir).sentences
    return R.cap_first_n(data, EVAL_CAP, ["seq", "sent_idx"]).select(
        "split", "article_id", "sent_idx", "text")


@register("sample_k", f"""
SELECT doc_id, CAST(row_number() OVER (ORDER BY k, doc_id) - 1 AS BIGINT) AS sample_rank
FROM (SELECT doc_id, md5('sample:{SEED}:' || CAST(doc_id AS VARCHAR)) AS k FROM documents
      ORDER BY k, doc_id LIMIT {SAMPLE_K})""")
def q_sample_k(spark, sf_dir):
    return R.sample_k(table(spark, sf_dir, "documents", "doc_id"), "doc_id", SAMPLE_K, SEED)


@register("rows_by_index", f"""
SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (
  SELECT doc_id FROM documents
  ORDER BY md5('sample:{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT {SAMPLE_K})""")
def q_rows_by_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "n_chars")
    idx = R.sample_k(table(spark, sf_dir, "documents", "doc_id"), "doc_id", SAMPLE_K, SEED)
    return R.rows_by_index(docs, idx, "doc_id")


@register("preview_first_n", f"""
WITH s AS (SELECT doc_id AS article_id, {O.kept_sentences('text')} AS sents FROM documents),
e AS (SELECT article_id, CAST(generate_subscripts(sents, 1) - 1 AS BIGINT) AS sent_idx,
             unnest(sents) AS text FROM s)
SELECT * FROM e ORDER BY article_id, sent_idx LIMIT 10""")
def q_preview_first_n(spark, sf_dir):
    return S.sentences(_articles(spark, sf_dir)).orderBy("article_id", "sent_idx").limit(10)
