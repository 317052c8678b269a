"""Article table -> seeded, size-budgeted, disjoint sentence splits.

The Spark form of the reference's corpus builder: extract and filter
sentences once per article (persisted), walk the seeded order with a prefix
sum, label splits by sequence range, then explode the sentences of the
chosen articles only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import posexplode_rows
from ..operators import sampling as R
from ..operators import sentences as S

# The reference's test-mode budgets (MiB) and sentence bounds.
TEST_BUDGETS = {"train": 1.0, "val": 0.1, "test": 0.1}


# Partition column of ``write_layout``: the first digits of the order key.
LAYOUT, LAYOUT_DIGITS = "order_bucket", 2


def write_layout(articles: DataFrame, path: str, seed: int = 0) -> DataFrame:
    """Articles stored by the first digits of their seeded order key, read back.

    Written once for many builds with that seed: a build that stops early then reads
    only the folders of its prefix instead of scanning the table in each pass.
    """
    bucket = R.hash_bucket_of(R.shuffle_key("article_id", seed), LAYOUT_DIGITS)
    (articles.withColumn(LAYOUT, bucket).withColumn("_seed", F.lit(seed)).repartition(LAYOUT)
     .write.mode("overwrite").partitionBy(LAYOUT).parquet(path))
    return articles.sparkSession.read.parquet(path)


@dataclass
class SplitBuild:
    sentences: DataFrame     # split, article_id, sent_idx, text
    manifest: DataFrame      # id, title, dataset_id, split, seq
    stats: DataFrame         # split, n_articles, n_sentences, size_bytes, budget_bytes, frac
    bounds: list             # [(split, first_seq, last_seq)]
    config: dict


def _sized(articles: DataFrame, min_spaces, max_spaces, use_transliteration) -> DataFrame:
    return (S.sentence_arrays(articles, min_spaces, max_spaces, use_transliteration)
            .persist(StorageLevel.MEMORY_AND_DISK))


# Shares of the kept bytes: the last split takes whatever is left.
WHOLE_SHARES = {"train": 0.8, "val": 0.1, "test": 1.0}


def build_splits(articles: DataFrame, budgets_mib: dict[str, float] | None = None,
                 shuffle: bool = True, seed: int = 0, min_spaces: int | None = 5,
                 max_spaces: int | None = 200, use_transliteration: bool = False,
                 hex_digits: int = 3, early_stop: bool = True,
                 first_fraction: float | None = None, kept_share: float = 0.3,
                 shares: dict[str, float] | None = None) -> SplitBuild:
    """Sentences of seeded, size-budgeted, disjoint splits.

    Budgets are MiB per split (``TEST_BUDGETS`` if none are given) or, with
    ``shares``, parts of all kept bytes; shares need the whole table, so
    there is no early stop then.

    With ``early_stop`` (shuffled order only) sentences are extracted for a
    prefix of the hash order (the first buckets), and the prefix grows until
    the last split closes inside it.  The first prefix comes from the budget
    and the table's bytes, as if ``kept_share`` of them became sentences;
    ``hex_digits`` grows until a bucket is a small part of it.  Boundaries
    depend only on the order prefix, so the result equals the full walk.
    """
    id_col = "article_id" if shuffle else "dataset_id"
    sized = None
    if shares is not None:
        sized = _sized(articles, min_spaces, max_spaces, use_transliteration)
        kept = sized.agg(F.sum("size_bytes")).first()[0] or 0
        # Exact: a division by a power of two and back.
        budgets_mib = {k: v * kept / R.MIB for k, v in shares.items()}
        early_stop = False
    elif budgets_mib is None:
        budgets_mib = TEST_BUDGETS
    if LAYOUT in articles.columns:
        hex_digits = max(hex_digits, LAYOUT_DIGITS)
        if articles.where(F.col("_seed") != seed).limit(1).count():
            raise ValueError("the layout was written for another seed")
        articles = articles.drop("_seed")
    if early_stop and shuffle and first_fraction is None:
        total, rows = articles.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
        budget = sum(float(v) for v in budgets_mib.values()) * R.MIB
        first_fraction = min(1.0, budget / (kept_share * (total or 1)))
        # At least 16 buckets in the prefix, but no finer than about an article each.
        while 16 ** hex_digits * first_fraction < 16 and 16 ** hex_digits < rows and hex_digits < 7:
            hex_digits += 1
    n_b = 16 ** hex_digits
    if not (early_stop and shuffle):
        sized = sized or _sized(articles, min_spaces, max_spaces, use_transliteration)
        narrow = sized.select("article_id", "title", "dataset_id", "n_sent", "size_bytes")
        assigned, bounds = R.budget_split(narrow, budgets_mib, seed if shuffle else None,
                                          id_col=id_col)
    else:
        need = sum(float(v) for v in budgets_mib.values()) * R.MIB
        bucket = R.hash_bucket_of(R.shuffle_key("article_id", seed), hex_digits)
        parts, lo, hi = [], 0, max(1, int(n_b * first_fraction))
        while True:
            # extract only the new bucket range; earlier ranges stay persisted
            part = articles.where((bucket >= F.lit(lo)) & (bucket < F.lit(hi)))
            if LAYOUT in articles.columns:      # folders outside the range are not read
                coarse = n_b // 16 ** LAYOUT_DIGITS
                part = part.where(F.col(LAYOUT).between(lo // coarse, (hi - 1) // coarse))
            parts.append(_sized(part, min_spaces, max_spaces, use_transliteration))
            sized = parts[0]
            for x in parts[1:]:
                sized = sized.unionByName(x)
            narrow = sized.select("article_id", "title", "dataset_id", "n_sent", "size_bytes")
            assigned, bounds, pos = R.budget_split(narrow, budgets_mib, seed, id_col=id_col,
                                                   return_positions=True)
            if hi >= n_b:
                break
            n_rows, kept = pos.agg(F.count(F.lit(1)), F.sum("size_bytes")).first()
            split, first, last = bounds[-1]
            if last >= first and last + 1 < n_rows:
                break                                # the last split closed inside the prefix
            # extrapolate the prefix from the kept bytes seen so far (at least double it)
            guess = int(hi * 1.25 * need / kept) + 1 if kept else 2 * hi
            lo, hi = hi, min(n_b, max(2 * hi, guess))
    manifest = assigned.select(F.col("article_id").alias("id"), "title", "dataset_id",
                               "split", "seq")
    chosen = assigned.select("article_id", "split", "seq")
    sents = (posexplode_rows(chosen.join(sized.select("article_id", "sents"), "article_id"),
                             ["split", "article_id", "seq"], F.col("sents"), "sent_idx", "text")
             .withColumn("sent_idx", F.col("sent_idx").cast("bigint")))
    budgets = articles.sparkSession.createDataFrame(
        [(k, int(float(v) * R.MIB)) for k, v in budgets_mib.items()],
        "split string, budget_bytes bigint")
    stats = (assigned.groupBy("split")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n_articles"),
                  F.sum("n_sent").cast("bigint").alias("n_sentences"),
                  F.sum("size_bytes").cast("bigint").alias("size_bytes"))
             .join(F.broadcast(budgets), "split", "right")
             .select("split",
                     F.coalesce("n_articles", F.lit(0)).cast("bigint").alias("n_articles"),
                     F.coalesce("n_sentences", F.lit(0)).cast("bigint").alias("n_sentences"),
                     F.coalesce("size_bytes", F.lit(0)).cast("bigint").alias("size_bytes"),
                     "budget_bytes",
                     F.round(F.coalesce("size_bytes", F.lit(0)) / F.when(F.col("budget_bytes") > 0, F.col("budget_bytes")), 6)
                     .alias("frac")))
    config = dict(split_sizes_MB=dict(budgets_mib), shares=shares, shuffle=shuffle, random_seed=seed,
                  sent_min_spaces=min_spaces, sent_max_spaces=max_spaces,
                  use_transliteration=use_transliteration)
    return SplitBuild(sents, manifest, stats, bounds, config)


def write_build(b: SplitBuild, out_dir: str, fmt: str = "parquet", compress: bool = True,
                force_rebuild: bool = True) -> None:
    """Sentences per split, the article manifest and the config.

    With ``force_rebuild=False`` existing outputs are kept (write mode
    ``ignore``), the reuse policy of the reference's loader.
    """
    from ..sources import files
    mode = files.reload_mode(force_rebuild)
    spark = b.sentences.sparkSession
    files.write_sentences(b.sentences.select("split", "article_id", "sent_idx", "text"),
                          f"{out_dir}/sentences", fmt, compress, mode)
    files.write_manifest(b.manifest, f"{out_dir}/articles", compress, mode)
    files.write_config(spark, b.config, f"{out_dir}/config", mode)


def build_and_reload(articles: DataFrame, out_dir: str, budgets_mib: dict[str, float] | None = None,
                     fmt: str = "parquet", **kw) -> DataFrame:
    """Build, write, and return the splits read back from storage (the
    written table also cuts the lineage of the build)."""
    from ..sources import files
    b = build_splits(articles, budgets_mib, **kw)
    write_build(b, out_dir, fmt)
    return files.read_sentences(articles.sparkSession, f"{out_dir}/sentences", fmt)
