"""Checked queries for predictions and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as MT
from ..sources.tables import table
from .registry import register


@register("argmax_scores", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred, label
FROM embeddings""")
def q_argmax_scores(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e.select("vec_id", MT.argmax("embedding").alias("pred"), "label")


_NCLS = "(SELECT count(DISTINCT label) FROM embeddings)"


@register("masked_accuracy", f"""
WITH p AS (SELECT CASE WHEN vec_id % 3 = 0 THEN -100 ELSE label END AS label, list_position(embedding[1:{_NCLS}], list_max(embedding[1:{_NCLS}])) - 1 AS pred
           FROM embeddings)
SELECT round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n
FROM p WHERE label <> -100""")
def q_masked_accuracy(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    n_cls = e.select(F.countDistinct("label")).first()[0]      # class count from the labels (P12)
    # Every third row is masked, as positions without a label are.
    label = F.when(F.col("vec_id") % 3 == 0, MT.NULL_LABEL).otherwise(F.col("label"))
    p = e.select(MT.argmax(F.slice("embedding", 1, n_cls)).alias("pred"), label.alias("label"))
    return MT.masked_accuracy(p, "pred", "label").select(F.round("accuracy", 6).alias("accuracy"), "n")


@register("binary_metrics", """
WITH c AS (SELECT sum(CASE WHEN toxic = 1 AND quality = 1 THEN 1 ELSE 0 END) AS tp,
                  sum(CASE WHEN toxic = 1 AND quality = 0 THEN 1 ELSE 0 END) AS fp,
                  sum(CASE WHEN toxic = 0 AND quality = 1 THEN 1 ELSE 0 END) AS fn,
                  avg(CASE WHEN toxic = quality THEN 1.0 ELSE 0.0 END) AS acc, count(*) AS n FROM labels)
SELECT round(acc, 6) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1,
       CAST(n AS BIGINT) AS n FROM c""")
def q_binary_metrics(spark, sf_dir):
    lab = table(spark, sf_dir, "labels", "quality", "toxic")
    return MT.binary_metrics(lab, "toxic", "quality")
