"""A training-data pipeline over ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

1. quality: documents that the classifier rejects go.
2. exact dedup: of documents equal but for white space the longest stays.
3. n-gram join: of each group of near copies the smallest doc_id stays.
4. decontamination: documents that hold benchmark passages go.
5. packing: length buckets and token-budget batches of what is left.

Rows are told apart by a number that is written once with the stage's input, so
repeated rows and ids are judged one by one, however later scans are cut.  Null and empty texts are judged like others;
an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import decontam, exact_dedup, ngram_join, packing, quality
from corpusmill.llm.common import materialize, read

# Row numbers up to this count are broadcast; beyond it the join is shuffled.
MAX_BROADCAST = 1_000_000


def _numbered(docs: DataFrame) -> tuple:
    """(``docs`` with a row number that is written, and so equal in every scan; its column,
    named so that no column of ``docs`` has that name)."""
    row, taken = "row_in_stage", {c.lower() for c in docs.columns}
    while row in taken:
        row = "_" + row
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _without(rows: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """The numbered ``rows`` without those in ``gone``, as columns of ``documents``."""
    gone = materialize(gone.select(row).distinct(), "dropped")
    few = gone.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    return rows.join(F.broadcast(gone) if few else gone, row, "left_anti").drop(row)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return docs.filter(quality.score(F.col("text"), model) >= quality.THRESHOLD) if model else docs


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs)
    judged = exact_dedup.exact_dedup(rows, place_col=row)
    return _without(rows, judged.filter("NOT kept").select(F.col("place").alias(row)), row)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs)
    groups = (ngram_join.jaccard_components(rows, id_col=row).filter("component_size > 1")
              .select(F.col("doc_id").alias(row), "component_id"))
    groups = materialize(groups.join(rows.select(row, "doc_id"), row), "near-copies")
    # The smallest doc_id of a group stays; null ids come last.
    best = groups.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))[row].alias("stays"))
    return _without(rows, groups.join(best, "component_id").filter(F.col(row) != F.col("stays")), row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = _numbered(docs)
    hits = decontam.contaminated(rows, read(spark, sf_dir, "benchmark", "item_id", "text"), id_col=row)
    return _without(rows, hits.select(F.col("doc_id").alias(row)), row)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_dedup_stage), ("ngram_join", ngram_join_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]

# The quality stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
