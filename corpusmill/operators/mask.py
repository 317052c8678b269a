"""Masked-language-model masking (K14) and the side-by-side view.

Each position draws its uniforms from the hex digits of one
``md5(seed:row:pos)``, so masking is reproducible for any partitioning and on task retry.  Special tokens are
never chosen.  A chosen position is replaced by [MASK] 80%, a hashed random
token 10%, and kept 10% of the time; its label is the original id, all other
labels are -100.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.digests import md5_of_numbered
from .align import NULL_LABEL
from .encode import list_sizes, with_texts
from .vocab import MASK_ID, SPECIALS

SCALE = float(2 ** 32)
ROWS = 1024

# The UDF travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mask_batch(keys: pa.Array, column: pa.Array, vocab_size: int, probability: float, n_special: int) -> tuple:
    """Masked ids and labels (flat arrays) of a batch of id lists, by the digest of
    each position's text ``key`` + number."""
    rows = list_sizes(column)
    flat = column.flatten()
    ids = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.flatnonzero(ids >= n_special)
    row = np.repeat(np.arange(len(rows)), rows)[at]
    u = md5_of_numbered(keys, row, at - (np.cumsum(rows) - rows)[row])
    chosen = u[:, 0] < probability * SCALE
    at, u = at[chosen], u[chosen]
    old = ids[at]
    masked, labels = ids.copy(), np.full(len(ids), NULL_LABEL, np.int32)
    labels[at] = old
    other = u[:, 2].astype(np.int64) % max(vocab_size - n_special, 1) + n_special
    masked[at] = np.where(u[:, 1] < 0.8 * SCALE, MASK_ID, np.where(u[:, 1] < 0.9 * SCALE, other, old))
    return (pa.array(masked.astype(np.int32), mask=flat.is_null().to_numpy(zero_copy_only=False)), pa.array(labels))


def mlm_mask(df: DataFrame, row_key: Column, ids_col: str = "input_ids", vocab_size: int = 20000,
             probability: float = 0.15, seed: int = 0, n_special: int = len(SPECIALS)) -> DataFrame:
    """Adds ``masked_ids`` and ``mlm_labels``, both from one walk over the ids."""
    @F.arrow_udf("m array<int>, l array<int>")
    def decided(key: pa.Array, column: pa.Array) -> pa.Array:
        ends = pa.array(np.concatenate([[0], np.cumsum(list_sizes(column))]).astype(np.int32))
        # Some rows at a time: what one position takes is held for those only.
        parts = [mask_batch(key.slice(i, ROWS), column.slice(i, ROWS), vocab_size, probability, n_special)
                 for i in range(0, max(len(column), 1), ROWS)]
        values = [pa.concat_arrays(v) for v in zip(*parts)]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, v, mask=column.is_null()) for v in values], ["m", "l"])

    # The part of the digest's text that the ids of a row share.
    shared = F.concat(F.concat_ws(":", F.lit(str(seed)), row_key), F.lit(":"))
    return (df.withColumn("_decided", decided(shared, F.col(ids_col).cast("array<int>")))
            .withColumn("masked_ids", F.col("_decided")["m"])
            .withColumn("mlm_labels", F.col("_decided")["l"]).drop("_decided"))


def mask_view(df: DataFrame, id_cols: list[str], vocab: DataFrame, ids_col: str = "input_ids",
              masked_col: str = "masked_ids", predicted_col: str | None = None) -> DataFrame:
    """``original``, ``masked`` and, with ``predicted_col``, ``predicted``
    texts side by side, without the outer CLS and SEP."""
    shown = {"original": ids_col, "masked": masked_col}
    if predicted_col:
        shown["predicted"] = predicted_col
    out = df.select(*id_cols, *[F.slice(c, 2, F.greatest(F.size(c) - 2, F.lit(0))).alias(name) for name, c in shown.items()])
    ids = out.select(*id_cols, *[F.col(name).alias(f"_{name}") for name in shown])
    return with_texts(ids, {name: f"_{name}" for name in shown}, vocab, skip_special_tokens=False).select(*id_cols, *shown)
