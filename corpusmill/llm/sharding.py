"""Sharding by sampled splitters, near-equal bytes per shard (law ``bytes``).

1. A size-weighted sample of keys (a row is drawn with probability
   proportional to its size, by a hash of its key) goes to the driver: ``SAMPLE`` keys,
   or ``SAMPLES_PER_RANGE`` a range where there are very many ranges.
2. Its weighted quantiles are the splitters of ``ranges`` key ranges, and rows
   are range-partitioned by them.
3. Exact bytes per range are summed; a range above ``OVERFULL`` times the mean
   is subdivided with evenly spaced splitters until none is (or it holds one key).
4. Inside each range a window sums bytes in key order; with the exact bytes
   before the range this gives each row's byte position, which decides its
   shard.  Shard loads differ from the mean by at most one row.

The key is (CRC-32 of the text, hash of the doc_id): copies of a text are
neighbours, and a group of copies with a third of all rows still subdivides.

Defined results: a null text has size 16 and CRC 0; a null doc_id is hashed
like any value; repeated rows share a key and get different slots; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize

SAMPLE = 16384
ROW_OVERHEAD = 16
OVERFULL = 2.0
RANGES_PER_SHARD = 8
# A range holds narrow rows (40 bytes) of one window task: about 160 MB.
ROWS_PER_RANGE = 1 << 22
SAMPLES_PER_RANGE = 16
LOW_BITS = 31


def choose_splitters(keys: np.ndarray, weights: np.ndarray, ranges: int) -> np.ndarray:
    """Weighted quantiles: ``ranges - 1`` at most, strictly increasing."""
    if not len(keys):
        return np.array([], dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    total = np.cumsum(weights[order])
    at = np.searchsorted(total, total[-1] * np.arange(1, ranges) / ranges)
    return np.unique(keys[order][np.minimum(at, len(keys) - 1)])


def range_of(key, splitters: np.ndarray):
    """Number of splitters at or below each key, vectorised in the tasks."""
    @F.pandas_udf("int")
    def index(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, k.to_numpy(), side="right").astype(np.int32))

    return index(key)


def _subdivide(splitters: np.ndarray, sizes: dict, lo: dict, hi: dict, mean: float) -> np.ndarray:
    """Splitters with more of them, evenly spaced, inside overfull ranges."""
    more = [splitters]
    for r, size in sizes.items():
        if size > OVERFULL * mean and hi[r] > lo[r]:
            n = int(np.ceil(size / mean))
            step = (hi[r] - lo[r]) // n + 1
            more.append(np.array([lo[r] + step * i for i in range(1, n) if lo[r] + step * i <= hi[r]], dtype=np.int64))
    return np.unique(np.concatenate(more))


def shard_records(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                  sample: int = SAMPLE, rounds: int = 6) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(text.cast("binary"))
    low = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).bitwiseAND((1 << LOW_BITS) - 1)
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        crc.alias("text_crc32"), F.shiftleft(crc, LOW_BITS).bitwiseOR(low).alias("key")), "shard-rows")
    total, n_rows = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    if total is None:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    ranges = max(n_shards * RANGES_PER_SHARD, n_rows // ROWS_PER_RANGE)
    rate = max(sample, SAMPLES_PER_RANGE * ranges) / total
    # Uniform in [0, 1) from the key, so a retried task draws the same rows.
    draw = F.pmod(F.xxhash64("key", "size", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(draw < F.col("size") * rate).select("key", F.greatest(F.col("size") * rate, F.lit(1.0)).alias("w")).collect()
    splitters = choose_splitters(np.array([r.key for r in drawn], dtype=np.int64),
                                 np.array([r.w for r in drawn], dtype=np.float64), ranges)
    mean = total / ranges
    for _ in range(rounds):
        parts = (rows.groupBy(range_of(F.col("key"), splitters).alias("range"))
                 .agg(F.sum("size").alias("size"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
        finer = _subdivide(splitters, {p.range: p["size"] for p in parts}, {p.range: p.lo for p in parts},
                           {p.range: p.hi for p in parts}, mean)
        if len(finer) == len(splitters):
            break
        splitters = finer
    ranged = rows.withColumn("range", range_of(F.col("key"), splitters))
    return _place(ranged, n_shards, total)


def _place(ranged: DataFrame, n_shards: int, total: int) -> DataFrame:
    """Shard and slot from exact byte and row positions in key order."""
    spark = ranged.sparkSession
    sums = sorted(ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect())
    offsets, b, n = [], 0, 0
    for r in sums:
        offsets.append((r.range, b, n))
        b, n = b + r.b, n + r.n
    offsets = spark.createDataFrame(offsets, "range int, bytes_before long, rows_before long")
    # One row per range: as many as splitters were chosen.
    w = Window.partitionBy("range").orderBy("key", "doc_id", "size")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (ranged.withColumn("_b", F.sum("size").over(upto)).withColumn("_n", F.row_number().over(w))
              .join(F.broadcast(offsets), "range")
              .withColumn("_mid", F.col("bytes_before") + F.col("_b") - F.col("size") / 2)
              .withColumn("shard", F.least(F.floor(F.col("_mid") * n_shards / float(total)), F.lit(n_shards - 1)).cast("int"))
              .withColumn("_i", F.col("rows_before") + F.col("_n") - 1))
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "shard", "_i"), "shard-placed")
    first = placed.groupBy("shard").agg(F.min("_i").alias("_first"))
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_i") - F.col("_first")).alias("slot")))
