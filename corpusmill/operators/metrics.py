"""Read-out and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import explode_rows
from .align import NULL_LABEL


def argmax(scores) -> Column:
    """Index of the largest score, first on ties (0-based)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def masked_accuracy(df: DataFrame, pred_col: str, label_col: str,
                    null_label: int = NULL_LABEL) -> DataFrame:
    """Accuracy over rows whose label is not ``null_label``."""
    return (df.where(F.col(label_col) != null_label)
            .agg(F.avg((F.col(pred_col) == F.col(label_col)).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).cast("bigint").alias("n")))


def binary_metrics(df: DataFrame, pred_col: str, ref_col: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of 0/1 predictions (one pass)."""
    p, r = F.col(pred_col), F.col(ref_col)
    tp = F.sum(((p == 1) & (r == 1)).cast("bigint"))
    fp = F.sum(((p == 1) & (r == 0)).cast("bigint"))
    fn = F.sum(((p == 0) & (r == 1)).cast("bigint"))
    acc = F.avg((p == r).cast("double"))
    out = df.agg(acc.alias("accuracy"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                 F.count(F.lit(1)).cast("bigint").alias("n"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
                2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(0.0)
    return out.select(F.round("accuracy", 6).alias("accuracy"), F.round(prec, 6).alias("precision"),
                      F.round(rec, 6).alias("recall"), F.round(f1, 6).alias("f1"), "n")


def entities(df: DataFrame, id_cols: list[str], pred_col: str = "pred", mask_col: str = "attention_mask",
             word_ids_col: str = "word_ids", words_col: str = "words",
             strict_compat: bool = False) -> DataFrame:
    """Words with a non-zero predicted class, classes grouped by word text.

    Positions run over the real tokens: ``sum(mask) - 2`` of them after CLS
    (A10).  With ``strict_compat`` that count is used even when a cut removed
    SEP (the reference then ignores one real token); by default a row cut at
    the maximum length keeps all its non-CLS tokens.  A position whose word
    id is NULL is reported as ``[INV]``.  Output is long form
    ``(ids..., word, first_pos, tags)``, ``tags`` in position order.
    """
    mask = F.col(mask_col)
    total = F.aggregate(mask, F.lit(0), lambda a, x: a + x)
    last_wid = F.try_element_at(F.col(word_ids_col), F.greatest(F.size(mask), F.lit(1)))
    cut = last_wid.isNotNull() if not strict_compat else F.lit(False)
    valid = F.when(cut, total - 1).otherwise(total - 2)
    # Positions without a class leave inside the row: no row is made of them, and the words are not copied.
    z = F.arrays_zip(F.col(pred_col).alias("p"), F.col(word_ids_col).alias("w"),
                     F.sequence(F.lit(0), F.greatest(F.size(pred_col) - 1, F.lit(0))).alias("pos"))
    z = F.filter(F.slice(z, F.lit(2), F.greatest(valid, F.lit(0))), lambda x: x["p"] != 0)
    found = F.transform(z, lambda x: F.struct(
        F.coalesce(F.try_element_at(F.col(words_col), x["w"] + 1), F.lit("[INV]")).alias("word"),
        (x["pos"] - 1).cast("bigint").alias("pos"), x["p"].alias("p")))
    z = explode_rows(df, id_cols, found, "z").select(*id_cols, "z.word", "z.pos", "z.p")
    return (z.groupBy(*id_cols, "word")
            .agg(F.min("pos").alias("first_pos"),
                 F.array_sort(F.collect_list(F.struct("pos", "p"))).alias("ps"))
            .select(*id_cols, "word", "first_pos", F.transform("ps", lambda x: x["p"]).alias("tags")))
