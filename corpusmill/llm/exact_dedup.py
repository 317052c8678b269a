"""Exact deduplication by progressive refinement (native).

Texts are equal when identical after deleting whitespace.  The refinement:

1. group rows by normalised length; a length of its own ends a row's work;
2. of the others, group by a hash of the first ``PREFIX`` characters;
3. read the full content (a second scan) only where length and prefix collide,
   and group by the SHA-256 of the whole normalised text.

Colliding (length, prefix) keys reach the second scan as a fixed table of at
most ``FLAG_ROWS * FLAG_SLOTS`` slot numbers, which bounds the broadcast at
any corpus size.  A slot shared by chance only sends a row to step 3 for
nothing; the full hash decides.  No text is ever shuffled.

Defined results: a null text is empty; all empty texts form one group; a null
doc_id loses against any other; rows equal in every respect are told apart by
their position, so exactly one row of a group stays; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import SPACE, attach_groups, materialize

PREFIX = 64
FLAG_ROWS = 1024
FLAG_SLOTS = 1024


def _features(docs: DataFrame, id_col: str, text_col: str, place_col: str | None = None) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.regexp_replace(text, SPACE + "+", "")
    return (docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("chars"), norm.alias("norm"),
                        *([F.col(place_col).alias("place")] if place_col else []))
            .withColumn("len", F.length("norm")))


def surviving_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(len, prefix) keys that more than one row has, refined in two steps."""
    f = _features(docs, id_col, text_col).select("len", F.xxhash64(F.substring("norm", 1, PREFIX)).alias("prefix"))
    # Written once: both steps read it, and the texts are scanned once for both.
    by_prefix = materialize(f.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")), "prefixes")
    by_len = by_prefix.groupBy("len").agg(F.sum("n").alias("n_len")).filter("n_len > 1")
    return by_prefix.join(by_len, "len", "left_semi").filter("n > 1").select("len", "prefix")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_all: bool = False, place_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is null for rows that the refinement settles without
    their full content, unless ``hash_all`` asks for every row's digest.
    ``place_col`` names a column of ``docs`` that numbers its rows; it tells
    repeated rows apart and is returned as ``place``.  Without it they are
    numbered in the one scan that writes the judged rows.
    """
    slot = F.pmod(F.xxhash64("len", "prefix"), F.lit(FLAG_ROWS * FLAG_SLOTS))
    flags = (surviving_keys(docs, id_col, text_col).select(slot.alias("slot")).distinct()
             .groupBy((F.col("slot") % FLAG_ROWS).alias("flag_row"))
             .agg(F.collect_set((F.col("slot") / FLAG_ROWS).cast("int")).alias("slots")))
    f = (_features(docs, id_col, text_col, place_col)
         .withColumn("prefix", F.xxhash64(F.substring("norm", 1, PREFIX)))
         .withColumn("slot", slot))
    f = f.join(F.broadcast(flags), F.col("slot") % FLAG_ROWS == F.col("flag_row"), "left")
    hit = F.coalesce(F.array_contains("slots", (F.col("slot") / FLAG_ROWS).cast("int")), F.lit(False))
    full = F.sha2(F.col("norm"), 256)
    rows = materialize(f.withColumn("hit", hit).select(
        "doc_id", "chars", (F.col("place") if place_col else F.monotonically_increasing_id()).alias("pos"), "hit",
        (full if hash_all else F.when(F.col("hit"), full)).alias("text_sha256")), "exact")

    groups = (rows.filter("hit").groupBy("text_sha256")
              .agg(F.count(F.lit(1)).alias("group_size"),
                   F.max(F.struct("chars", F.bitwise_not("doc_id").alias("neg_id"),
                                  F.bitwise_not("pos").alias("neg_pos"))).alias("best"))
              .filter("group_size > 1")
              .select("text_sha256", "group_size", F.bitwise_not("best.neg_id").alias("best_id"),
                      F.bitwise_not("best.neg_pos").alias("best_pos")))
    out = attach_groups(rows, groups, "text_sha256", "group_size")
    alone = F.col("group_size").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("pos") == F.col("best_pos"))).alias("kept"), "text_sha256",
        *([F.col("pos").alias("place")] if place_col else []))
