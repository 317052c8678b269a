"""Global row positions without a single-task window.

Rows are range-partitioned by their order and sorted inside each partition.  A
row's number inside its partition is the low part of
``monotonically_increasing_id``; the totals of the partitions before it are
added.  How many partitions there are follows from the data (AQE merges small
ones), not from a fixed number of buckets, and a run of equal order values is
the only thing that cannot be split: give the order a tie-breaker that can.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

_IN_PARTITION = (1 << 33) - 1


def range_positions(df: DataFrame, order: list, size_col: str | None = None, name: str = "seq",
                    partitions: int | None = None) -> DataFrame:
    """Adds ``name``, the 0-based position of each row in ``order``.

    With ``size_col`` also ``before`` and ``cum``, the exclusive and inclusive
    running sum of that column.  The numbered rows are written once, so all
    readers see the same positions.  Range partitioning samples its input in a
    job of its own: pass a table that is cheap to read twice.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = stage(dealt.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()), "positions")
    rows = rows.withColumn("_part", F.shiftrightunsigned("_mid", 33))
    size = F.col(size_col).cast("bigint") if size_col else F.lit(0).cast("bigint")
    # One row per partition comes to the driver and goes back as offsets.
    totals = sorted(rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("s")).collect())
    offsets = [(t["_part"], n, s) for t, n, s in zip(
        totals, accumulate((t["n"] for t in totals), initial=0), accumulate((t["s"] for t in totals), initial=0))]
    offsets = spark.createDataFrame(offsets, "_part bigint, _rows_before bigint, _size_before bigint")
    out = rows.join(F.broadcast(offsets), "_part").withColumn(
        name, (F.col("_rows_before") + F.col("_mid").bitwiseAND(F.lit(_IN_PARTITION))).cast("bigint"))
    if size_col:
        upto = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        out = (out.withColumn("cum", (F.col("_size_before") + F.coalesce(F.sum(size).over(upto), F.lit(0))).cast("bigint"))
               .withColumn("before", F.col("cum") - F.coalesce(size, F.lit(0))))
    return out.drop("_part", "_mid", "_rows_before", "_size_before")
