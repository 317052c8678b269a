"""Checked queries: packing and sharding."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.llm import packing, sharding
from corpusmill.llm.common import read
from corpusmill.llm.registry import register


@register("op2_packing")
def op2(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))


@register("op3_sharding")
def op3(spark, sf_dir):
    out = sharding.shard_records(read(spark, sf_dir, "documents", "doc_id", "text"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
