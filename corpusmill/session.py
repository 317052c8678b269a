"""Session helpers: a local session for tests/bench and a checkpoint folder.

On a cluster the session is created by the platform; we only *read*
``spark.checkpoint.dir`` from it.  A folder of our own is set only when the
setting is missing (local tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpusmill") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d          # set before: setting it again would nest a folder in it
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: iterative operators "
                               "cut their lineage there")
        # Local runs only (tests, bench): a machine-local folder is fine there.
        d = tempfile.mkdtemp(prefix="corpusmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()
