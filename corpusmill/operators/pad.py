"""Dynamic padding to the longest row of each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import range_positions
from .vocab import PAD_ID


def batch_ids(df: DataFrame, order_cols: list[str], batch_size: int) -> DataFrame:
    """``batch`` = position div ``batch_size`` in a total order (``range_positions``)."""
    pos = range_positions(df, order_cols)
    return pos.withColumn("batch", F.floor(F.col("seq") / F.lit(batch_size)).cast("bigint"))


def pad_batches(df: DataFrame, ids_col: str = "input_ids", batch_col: str = "batch",
                pad_id: int = PAD_ID) -> DataFrame:
    """Pad ``input_ids`` (and an all-ones mask) to the batch maximum length.

    The maximum is an aggregate of two narrow columns, joined back; a batch has
    ``batch_size`` rows, so no key is hot.
    """
    n = F.size(ids_col)
    longest = df.groupBy(batch_col).agg(F.max(n).cast("bigint").alias("padded_len"))
    missing = F.col("padded_len").cast("int") - n
    return (df.join(longest, batch_col)
            .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), missing)))
            .withColumn(ids_col, F.concat(F.col(ids_col), F.array_repeat(F.lit(pad_id), missing))))
