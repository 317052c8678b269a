"""Length buckets by dynamic programming, token-budget batches inside.

The global histogram of token lengths (exact up to ``EXACT`` tokens, then
``STEPS`` bins per doubling, so at most a few thousand bins at any corpus
size) goes to the driver.  Dynamic programming chooses the ``buckets`` upper
boundaries that minimise total padding; a row is padded to its bucket's
boundary.  Inside a bucket, rows in hashed order fill batches of
``budget // boundary`` rows (one at least), so a batch of padded rows never
exceeds the token budget unless a single row does.

Defined results: null, empty and blank texts have 0 tokens and are placed in
the first bucket; texts are never cut; repeated rows are separate rows;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import NOT_SPACE, materialize, number_rows

BUCKETS = 12
BUDGET = 16384
EXACT = 1024
STEPS = 256
ROWS_PER_CHUNK = 50_000


def word_count(text: Column) -> Column:
    """Tokens are words here: a run of non-space characters is one token."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE + "+"))


def length_bin(n: Column) -> Column:
    """Monotone bin number: exact lengths first, then 1/256 of a doubling."""
    n = n.cast("double")
    fine = F.floor(F.log2(F.greatest(n, F.lit(float(EXACT))) / EXACT) * STEPS)
    return F.when(n < EXACT, n.cast("int")).otherwise((F.lit(EXACT) + fine).cast("int"))


def optimal_boundaries(longest: np.ndarray, counts: np.ndarray, sums: np.ndarray, buckets: int) -> list:
    """Bin indices that end the buckets, for least padding.

    Bins are in length order; ``longest`` is the longest row of each.
    cost(i, j) pads bins i..j to longest[j].  One vectorised row of the
    O(buckets * bins^2) recurrence at a time.
    """
    m = len(longest)
    cn = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    cs = np.concatenate([[0], np.cumsum(sums)]).astype(np.float64)
    best = longest * cn[1:] - cs[1:]
    back = []
    for _ in range(min(buckets, m) - 1):
        new, arg = best.copy(), np.full(m, -1)
        for j in range(1, m):
            # The last bucket is bins i+1..j, the ones before end at bin i.
            c = best[:j] + longest[j] * (cn[j + 1] - cn[1:j + 1]) - (cs[j + 1] - cs[1:j + 1])
            i = int(np.argmin(c))
            if c[i] < new[j]:
                new[j], arg[j] = c[i], i
        back.append(arg)
        best = new
    ends, j = [m - 1], m - 1
    for arg in reversed(back):
        if arg[j] >= 0:
            j = int(arg[j])
            ends.append(j)
    return ends[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_tokens, bucket, boundary, padding, batch, slot."""
    n = (word_count(F.col(text_col)) if length is None else length).cast("long")
    rows = (docs.select(F.col(id_col).alias("doc_id"), n.alias("n_tokens"))
            .withColumn("bin", length_bin(F.col("n_tokens"))))
    hashed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "n_tokens")
    # Only (doc_id, n_tokens, bin) is kept between the passes.
    kept, hist = _histogram(rows)
    if not hist:
        return kept.select("doc_id", "n_tokens", F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("boundary"),
                                     F.lit(0).cast("long").alias("padding"), F.lit(0).cast("long").alias("batch"),
                                     F.lit(0).cast("long").alias("slot"))
    longest = np.array([h.longest for h in hist], dtype=np.float64)
    counts = np.array([h.n for h in hist], dtype=np.float64)
    ends = optimal_boundaries(longest, counts, np.array([h.total for h in hist], dtype=np.float64), buckets)
    bounds = [int(longest[e]) for e in ends]
    bucket, boundary = F.lit(len(bounds) - 1), F.lit(bounds[-1]).cast("long")
    for b in range(len(bounds) - 2, -1, -1):
        inside = F.col("n_tokens") <= bounds[b]
        bucket, boundary = F.when(inside, b).otherwise(bucket), F.when(inside, bounds[b]).otherwise(boundary)
    chunks = max(1, int(counts.sum() // ROWS_PER_CHUNK) + 1) * 4
    per_batch = F.greatest(F.floor(F.lit(budget) / F.greatest("boundary", F.lit(1))), F.lit(1)).cast("long")
    out = number_rows(
        kept.select("doc_id", "n_tokens", bucket.cast("int").alias("bucket"), boundary.cast("long").alias("boundary")),
        ["bucket"], [hashed, "doc_id"], F.pmod(F.shiftright(hashed, 8), F.lit(chunks)), "pack")
    return out.select("doc_id", "n_tokens", "bucket", "boundary", (F.col("boundary") - F.col("n_tokens")).alias("padding"),
                      F.floor(F.col("row_index") / per_batch).cast("long").alias("batch"),
                      F.pmod("row_index", per_batch).cast("long").alias("slot"))


def _histogram(rows: DataFrame):
    kept = materialize(rows, "pack-lengths")
    hist = kept.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total"),
                                   F.max("n_tokens").alias("longest")).orderBy("bin").collect()
    return kept, hist
