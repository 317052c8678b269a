"""A count-based guess for masked positions (the prediction column of K15).

The most frequent token after each token is one count of neighbouring ids, made per batch
and combined; the result has at most one row per vocabulary entry, so it is broadcast.  A model's predictions fit the same columns.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .align import NULL_LABEL
from .vocab import SPECIALS

# The UDF travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def count_neighbours(batches):
    """(prev, next, n) of each batch of id lists; NULL ids are -2^31."""
    for batch in batches:
        column = batch.column(0)
        rows = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = pc.fill_null(column.flatten(), -1 << 31).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(rows)), rows)
        near = row[1:] == row[:-1]
        pairs, n = np.unique((ids[:-1][near] << 32) + (ids[1:][near] + (1 << 31)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array((pairs >> 32).astype(np.int32)), pa.array(
            ((pairs & 0xFFFFFFFF) - (1 << 31)).astype(np.int32)), pa.array(n.astype(np.int64))], ["prev", "next", "n"])


def next_token_table(df: DataFrame, ids_col: str = "input_ids", n_special: int = len(SPECIALS)) -> DataFrame:
    """``(prev, guess)``: the most frequent follower of each id (smaller id on ties),
    special tokens left out; ``prev`` NULL has the most frequent follower of all."""
    counts = (df.select(F.col(ids_col).cast("array<int>")).mapInArrow(count_neighbours, "prev int, next int, n bigint")
              .where(F.col("next") >= n_special)
              .groupBy(F.nullif("prev", F.lit(-1 << 31)).alias("prev"), "next").agg(F.sum("n").alias("n")))
    overall = counts.groupBy("next").agg(F.sum("n").alias("n")).select(F.lit(None).cast("int").alias("prev"), "next", "n")
    best = F.min(F.struct((-F.col("n")).alias("k"), "next"))
    return counts.unionByName(overall).groupBy("prev").agg(best["next"].alias("guess"))


def predict_masked(df: DataFrame, table: DataFrame, vocab_size: int, masked_col: str = "masked_ids",
                   labels_col: str = "mlm_labels", out_col: str = "predicted_ids") -> DataFrame:
    """Adds ``out_col``: masked positions (those with a label) guessed from the id
    before them, all others as they are."""
    rows = {r.prev: r.guess for r in table.collect()}        # at most one per id
    common = rows.get(None)
    guesses = df.sparkSession.sparkContext.broadcast(
        [-1 if rows.get(i, common) is None else rows.get(i, common) for i in range(vocab_size)])

    @F.arrow_udf("array<int>")
    def predicted(masked: pa.Array, labels: pa.Array) -> pa.Array:
        known = np.array([*guesses.value, -1], np.int32)
        size = pc.fill_null(pc.list_value_length(masked), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = masked.flatten()
        ids = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.concatenate([[-1], ids[:-1]])[:len(ids)]
        before[ends[:-1][size > 0]] = -1                # the first of a row has nothing before it
        guess = known[np.where((before < 0) | (before >= len(known)), len(known) - 1, before)]
        wanted = pc.fill_null(labels.flatten(), 0).to_numpy(zero_copy_only=False) != NULL_LABEL
        use = wanted & (guess >= 0)
        none = flat.is_null().to_numpy(zero_copy_only=False) & ~use
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(
            np.where(use, guess, ids).astype(np.int32), mask=none), mask=masked.is_null())

    # One label per id, as ``mlm_mask`` gives them.
    labels = F.slice(F.concat(labels_col, F.array_repeat(F.lit(NULL_LABEL), F.greatest(
        F.size(masked_col) - F.size(labels_col), F.lit(0)))), F.lit(1), F.size(masked_col))
    return df.withColumn(out_col, predicted(masked_col, labels))
