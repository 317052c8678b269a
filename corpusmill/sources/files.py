"""File sources and sinks.

Layout written by ``write_build``::

    <out>/sentences/split=<name>/part-*.csv.gz   (or parquet)   S7
    <out>/articles/part-*.csv.gz                                 S8
    <out>/config/part-*.json                                     S9

``split`` is a partition column, so reading one split prunes the others.
Readers take explicit schemas (no inference pass).  CSV is written and read
with ``multiLine`` and ``escape='"'``: that is what round-trips fields with
quotes, backslashes and carriage returns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SENTENCE_SCHEMA = "article_id bigint, text string"
# What ``write_sentences`` adds: the place of a sentence in its article.
ORDERED_SCHEMA = "article_id bigint, sent_idx bigint, text string"
MANIFEST_SCHEMA = "id bigint, title string, dataset_id bigint, split string, seq bigint"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem existence check, on the driver (one call per path)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def plain_or_gzip(spark: SparkSession, path: str) -> str:
    """S3: ``path`` if it exists, else ``path + '.gz'`` (codec follows the name)."""
    return path if _fs_exists(spark, path) else path + ".gz"


def csv_reader(spark: SparkSession, schema: str):
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"'))


def csv_writer(df: DataFrame, compress: bool = True, mode: str = "overwrite"):
    w = df.write.mode(mode).option("header", True).option("escape", '"')
    return w.option("compression", "gzip") if compress else w


def read_split_files(spark: SparkSession, directory: str, splits, schema: str = SENTENCE_SCHEMA) -> DataFrame:
    """``{split}_data.csv`` (or ``.csv.gz``) per split name, with a
    ``split`` column; iterating a dict of budgets gives its keys."""
    out = None
    for s in splits:
        df = csv_reader(spark, schema).csv(plain_or_gzip(spark, f"{directory}/{s}_data.csv"))
        df = df.withColumn("split", F.lit(s))
        out = df if out is None else out.unionByName(df)
    return out


def read_json_field(spark: SparkSession, path: str, field: str = "data",
                    item_schema: str = SENTENCE_SCHEMA) -> DataFrame:
    """Rows stored as ``{"<field>": [{...}, ...]}``.

    One such document is one record, so a file is read by one task; for
    large data write JSON Lines (``write_json_lines``), which splits.
    """
    schema = f"`{field}` array<struct<" + ", ".join(
        f"{c.split()[0]}: {c.split()[1]}" for c in item_schema.split(",")) + ">>"
    return (spark.read.schema(schema).option("multiLine", True).json(path)
            .select(F.inline(F.col(field))))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "gzip").json(path)


def write_sentences(df: DataFrame, path: str, fmt: str = "parquet", compress: bool = True,
                    mode: str = "overwrite") -> None:
    """One output per split (``partitionBy('split')``), CSV or parquet.

    Sentences keep their place in the article (``sent_idx``, null if ``df``
    has none), and files are sorted by article and place.
    """
    if "sent_idx" not in df.columns:
        df = df.withColumn("sent_idx", F.lit(None).cast("bigint"))
    df = df.sortWithinPartitions("split", "article_id", "sent_idx")
    if fmt == "csv":
        csv_writer(df.select("split", "article_id", "sent_idx", "text"), compress, mode).partitionBy("split").csv(path)
    else:
        df.write.mode(mode).partitionBy("split").parquet(path)


def read_sentences(spark: SparkSession, path: str, fmt: str = "parquet", splits=None) -> DataFrame:
    """Reader of ``write_sentences`` output; ``splits`` prunes partitions."""
    if fmt == "csv":
        df = csv_reader(spark, ORDERED_SCHEMA + ", split string").csv(path)
    else:
        df = spark.read.parquet(path)
    return df.where(F.col("split").isin(list(splits))) if splits else df


def write_manifest(manifest: DataFrame, path: str, compress: bool = True, mode: str = "overwrite") -> None:
    """Processed articles in processing order (``seq``)."""
    csv_writer(manifest.select("id", "title", "dataset_id", "split", "seq"), compress, mode).csv(path)


def write_config(spark: SparkSession, config: dict, path: str, mode: str = "overwrite") -> None:
    """The parameters of a build as one JSON row."""
    spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "config string") \
        .coalesce(1).write.mode(mode).text(path)


def read_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def reload_mode(force_rebuild: bool) -> str:
    """Rebuild (``overwrite``) or keep an existing output (``ignore``)."""
    return "overwrite" if force_rebuild else "ignore"
