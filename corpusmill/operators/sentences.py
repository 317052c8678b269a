"""Articles -> clean sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import posexplode_rows


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """The article schema ``(article_id, title, text, dataset_id)``.

    ``documents.doc_id`` plays both the article id and the row index of the
    source table; ``source`` plays the title.
    """
    return documents.select(
        F.col("doc_id").cast("bigint").alias("article_id"),
        F.col("source").alias("title"),
        F.col("text"),
        F.col("doc_id").cast("bigint").alias("dataset_id"),
    )


def sentence_arrays(articles: DataFrame, min_spaces: int | None = 5,
                    max_spaces: int | None = 200, use_transliteration: bool = False,
                    text_col: str = "text") -> DataFrame:
    """One row per article with its kept sentences, their count and size.

    The extraction runs once per article (Spark does not inline the
    ``sents`` expression into its three consumers: CollapseProject keeps a
    non-cheap expression that is referenced more than once).
    """
    out = articles.withColumn(
        "sents", T.keep_sentences(T.extract_sentences(text_col, use_transliteration),
                                  min_spaces, max_spaces))
    return (out.drop(text_col)
            .withColumn("n_sent", F.size("sents").cast("bigint"))
            .withColumn("size_bytes", T.text_bytes("sents")))


def sentences(articles: DataFrame, min_spaces: int | None = 5, max_spaces: int | None = 200,
              use_transliteration: bool = False, id_col: str = "article_id",
              text_col: str = "text") -> DataFrame:
    """P5: ``(article_id, sent_idx, text)``, one row per kept sentence."""
    s = T.keep_sentences(T.extract_sentences(text_col, use_transliteration),
                         min_spaces, max_spaces)
    return (posexplode_rows(articles, [F.col(id_col).alias("article_id")], s, "sent_idx", "text")
            .withColumn("sent_idx", F.col("sent_idx").cast("bigint")))
