"""Scans of the supplied parquet tables (S1) with explicit column pruning."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """``spark.read.parquet`` of one supplied table, optionally pruned."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-spread a scan that yields fewer splits than the cluster has cores.

    Text operators are CPU-bound per row; a table stored as one large row
    group scans as one task.  When the scan already has enough splits (any
    large input) this is a no-op, so no shuffle is added at scale.  Hashing
    on the id keeps later per-id aggregations free of another exchange.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key)


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """Pruned scan of a text table, spread over the available cores."""
    return spread(table(spark, sf_dir, name, *columns), key)
