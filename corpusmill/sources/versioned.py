"""Outputs keyed by the parameters that made them.

An output lives in ``<root>/<name>-<fingerprint>``; the fingerprint covers its parameters and,
through ``after``, those of the outputs it was made from.  A finished write
leaves Spark's ``_SUCCESS`` marker and, before it counts, the parameters beside the data; a folder
without its marker is a broken attempt and is written again.  So a changed parameter
rebuilds what depends on it, an unchanged one reads.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .files import _fs_exists, write_config


def fingerprint(params: dict, after: tuple = ()) -> str:
    text = json.dumps([params, list(after)], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


@dataclass
class Output:
    """A versioned output: its rows as read from storage, and where they are."""
    rows: DataFrame
    path: str
    version: str
    built: bool


def build_or_read(spark: SparkSession, root: str, name: str, params: dict, build: Callable[[], DataFrame],
                  after: tuple = (), force_rebuild: bool = False, partition_by: tuple = ()) -> Output:
    """The output ``name`` for ``params``: read if it was finished, else built and written.

    ``after`` are the versions of the outputs that ``build`` reads.  The returned rows are always
    read from storage, with file listings of earlier attempts dropped.
    """
    version = fingerprint(params, after)
    path = f"{root.rstrip('/')}/{name}-{version}"
    missing = force_rebuild or not _fs_exists(spark, f"{path}/data/_SUCCESS")
    if missing:
        write_config(spark, {"name": name, "params": params, "after": list(after)}, f"{path}/params")
        build().write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/data")
        spark.catalog.refreshByPath(f"{path}/data")
    return Output(spark.read.parquet(f"{path}/data"), path, version, missing)
