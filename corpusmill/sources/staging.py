"""Tables between the steps of one job, in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to ``spark.checkpoint.dir`` and read it back.

    Every later reader sees the same rows, and a lost executor costs a re-read
    instead of a recomputation.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
