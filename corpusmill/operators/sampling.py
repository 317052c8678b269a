"""Ordering, budgeted splits, caps and seeded samples.

The reference walks a permuted article list in one Python loop.  Here the
walk is a prefix sum: articles are range-partitioned by a seeded hash and
numbered inside each partition (``positions``), and the totals of the partitions
give each its global offset.  Split boundaries are then one
filtered aggregate per split, and the split label is a CASE over sequence
ranges, so no row ever has to travel to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .positions import range_positions

MIB = 1024 * 1024


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shuffle_key(id_col, seed: int = 0) -> Column:
    """Seeded, stable order key ``md5('<seed>:<id>')`` (hex string)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(id_col).cast("string")))


def hash_int(*parts: Column) -> Column:
    """Non-negative number from the first 32 bits of ``md5(p1:p2:...)``."""
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_bucket_of(key: Column, hex_digits: int = 3) -> Column:
    """Monotone bucket of an md5 hex key: its first ``hex_digits`` digits."""
    return F.conv(F.substring(key, 1, hex_digits), 16, 10).cast("int")


def seeded_order(df: DataFrame, id_col: str, seed: int | None = 0,
                 size_col: str | None = None) -> DataFrame:
    """Positions in seeded-shuffle order, or natural order (``seed=None``).

    ``df`` is narrow (ids and sizes) and cheap to read twice; ids with gaps or
    clusters fill the range partitions evenly.
    """
    if seed is None:
        return range_positions(df, [id_col], size_col)
    keyed = df.withColumn("shuffle_key", shuffle_key(id_col, seed))
    return range_positions(keyed, ["shuffle_key", id_col], size_col)


def split_boundaries(pos: DataFrame, budgets_mib: dict[str, float]) -> list[tuple[str, int, int]]:
    """``[(split, first_seq, last_seq)]``; last < first means empty.

    Split k takes the articles from ``first_k`` on while the size taken so
    far (before adding the article) does not exceed its budget, so its last
    article overshoots, as in the reference; the next split starts after it.
    """
    out, lo, base = [], 0, 0
    for split, mib in budgets_mib.items():
        limit = float(mib) * MIB
        hi, nbase = (pos.where((F.col("seq") >= lo) & ((F.col("before") - F.lit(base)) <= F.lit(limit)))
                     .agg(F.max("seq"), F.max("cum")).first())
        if hi is None:
            out.append((split, lo, lo - 1))
            continue
        out.append((split, lo, int(hi)))
        lo, base = int(hi) + 1, int(nbase)
    return out


def split_label(bounds: list[tuple[str, int, int]], seq: str = "seq") -> Column:
    expr = None
    for split, lo, hi in bounds:
        if hi < lo:
            continue
        cond = F.col(seq).between(lo, hi)
        expr = F.when(cond, F.lit(split)) if expr is None else expr.when(cond, F.lit(split))
    return expr if expr is not None else F.lit(None).cast("string")


def budget_split(sized: DataFrame, budgets_mib: dict[str, float], seed: int | None = 0,
                 id_col: str = "article_id", size_col: str = "size_bytes",
                 return_positions: bool = False):
    """R2: assign articles to size-budgeted, disjoint splits.

    ``sized`` has one row per article with its kept size.  Returns the
    processed articles with ``split`` and ``seq`` (the manifest, R4) and the
    boundaries.  Only the narrow columns go through the window.
    """
    pos = seeded_order(sized, id_col, seed, size_col)
    bounds = split_boundaries(pos, budgets_mib)
    last = max([hi for _, lo, hi in bounds if hi >= lo], default=-1)
    assigned = pos.where(F.col("seq") <= last).withColumn("split", split_label(bounds))
    return (assigned, bounds, pos) if return_positions else (assigned, bounds)


def cap_first_n(df: DataFrame, n: int | None, order_cols: list, split_col: str = "split",
                uncapped: tuple = ("train",)) -> DataFrame:
    """First ``n`` rows of every split except ``uncapped``; None = no cap.

    The cap is the feature (the evaluation row cap).  Spark plans the rank filter as a
    window group limit: a task keeps ``n`` rows of a split before anything is shuffled.
    """
    if n is None:
        return df
    free = F.coalesce(F.col(split_col).isin(list(uncapped)), F.lit(False))
    first = Window.partitionBy(split_col).orderBy(*order_cols)
    capped = df.where(~free).withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).drop("_rank")
    return df.where(free).unionByName(capped)


def sample_k(df: DataFrame, id_col: str, k: int, seed: int = 0) -> DataFrame:
    """Seeded random ``k`` rows (top-k by a hash key), with their rank."""
    key = F.md5(F.concat(F.lit(f"sample:{seed}:"), F.col(id_col).cast("string")))
    top = df.withColumn("_k", key).orderBy("_k", id_col).limit(k)
    w = Window.orderBy("_k", id_col)        # over k rows only
    return top.withColumn("sample_rank", (F.row_number().over(w) - 1).cast("bigint")).drop("_k")


BROADCAST_IDS = 1_000_000


def rows_by_index(df: DataFrame, index: DataFrame, on: str) -> DataFrame:
    """Rows whose index appears in ``index``.

    The id list is broadcast only after a count shows it is small; a large
    list takes a shuffle semi join.
    """
    ids = index.select(on).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, on, "left_semi")


def ids_in_all_splits(data: DataFrame, id_col: str = "article_id", split_col: str = "split",
                      n_splits: int | None = None) -> DataFrame:
    """A1/A2: ids present in every split (should be empty)."""
    if n_splits is None:
        n_splits = data.select(split_col).distinct().count()
    return (data.groupBy(id_col).agg(F.countDistinct(split_col).alias("_n"))
            .where(F.col("_n") == n_splits).drop("_n"))
