"""Helpers shared by the training-data operators.

* ``materialize`` cuts lineage with a Parquet table in the shared checkpoint
  folder (``spark.checkpoint.dir``), so that a lost executor costs a re-read.
* ``attach_groups`` joins per-row data with per-group results when one group
  may hold a third of all rows.
* ``match_spans`` gives regex spans as a Column expression.
* ``number_rows`` numbers rows globally without a single-task window.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions.arrays import let, scan_array, scan_sql, sql_string
from corpusmill.session import checkpoint_dir

# Fixed value: the whitespace class of the contracts, [\x20\x09-\x0D].
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

# Largest number of groups that ``attach_groups`` broadcasts.
HOT_GROUPS = 256


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/corpusmill-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str,
                  how: str = "left", hot: int = HOT_GROUPS) -> DataFrame:
    """``rows`` joined with ``groups`` on ``key``, safe for hot keys.

    The ``hot`` largest groups (at most that many rows whatever the input)
    are broadcast; rows they serve get a key of their own in the following
    shuffle join, so they spread evenly instead of meeting in one task.
    ``groups`` must have one row per key and is read twice: pass a stored table, or one
    that is cheap to compute.  Null keys match nothing.
    """
    others = [c for c in groups.columns if c != key]
    top = (groups.filter(F.col(key).isNotNull())
           .orderBy(F.desc(size), F.asc(key)).limit(hot)
           .select(F.col(key).alias("_hot_key"), F.struct(*others).alias("_hot")))
    rest = groups.select(F.col(key).cast("string").alias("_join_key"), F.struct(*others).alias("_cold"))
    out = rows.join(F.broadcast(top), F.col(key) == F.col("_hot_key"), "left")
    # A key no group has: '~' never starts a hash or a number.
    own = F.concat(F.lit("~"), F.xxhash64(*[F.col(c) for c in rows.columns]).cast("string"))
    out = out.withColumn("_row_key", F.when(F.col("_hot_key").isNotNull() | F.col(key).isNull(), own)
                         .otherwise(F.col(key).cast("string")))
    out = out.join(rest, F.col("_row_key") == F.col("_join_key"), "left")
    out = out.withColumn("_g", F.coalesce("_hot", "_cold"))
    if how == "inner":
        out = out.filter(F.col("_g").isNotNull())
    return out.select(*rows.columns, *[F.col(f"_g.{c}").alias(c) for c in others])


def match_spans(text: str, pattern: str, context: int = 0) -> Column:
    """array<struct<s,e,m>>: leftmost non-overlapping matches in column ``text``, code points.

    Matches and the gaps between them come from two regex passes that only
    rows with a match run; one scan adds up the lengths, in near linear
    time.  With ``context`` also ``near``, the ``context`` characters before a
    match, taken from the gaps instead of counting through the text again.
    """
    kind = "struct<s:int,e:int,m:string" + (",near:string>" if context else ">")
    t, p = f"`{text}`", sql_string(pattern)
    items = f"transform(arrays_zip(regexp_extract_all({t}, {p}, 0), split({t}, {p}, -1)), z -> named_struct('m', z['0'], 'g', z['1']))"
    at = "a.st.p" if context else "a.st"
    start, end = f"({at} + length(x.g))", f"({at} + length(x.g) + coalesce(length(x.m), 0))"
    state, after, near = "0", end, ""
    if context:
        before = f"right(concat(a.st.near, x.g), {context})"
        state, near = "named_struct('p', 0, 'near', '')", f", 'near', {before}"
        after = f"named_struct('p', {end}, 'near', right(concat({before}, coalesce(x.m, '')), {context}))"
    found = f"if(x.m IS NULL, NULL, array(named_struct('s', {start}, 'e', {end}, 'm', x.m{near})))"
    scan = scan_sql(items, state, after, found, kind)
    return F.expr(f"CASE WHEN {t} RLIKE {p} THEN {scan} ELSE cast(array() AS array<{kind}>) END")


def apart(spans: Column, others: Column, kind: str) -> Column:
    """The ``spans`` (array<kind> with s and e) that overlap none of ``others``.

    Few spans are compared pair by pair.  Many are sorted with the others by start:
    what starts before a span and reaches into it is seen going up, what starts inside
    it going down.
    """
    def pairs(v):
        return F.filter(v["a"], lambda x: ~F.exists(v["b"], lambda o: (o["s"] < x["e"]) & (o["e"] > x["s"])))

    def sweep(v):
        item = f"struct<s:int,own:int,e:int,x:{kind}>"
        marks = F.array_sort(F.concat(
            F.transform(v["b"], lambda o: F.struct(o["s"].alias("s"), F.lit(0).alias("own"), o["e"].alias("e"), F.lit(None).cast(kind).alias("x"))),
            F.transform(v["a"], lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("own"), x["e"].alias("e"), x.alias("x")))))
        none, gone = F.array().cast(f"array<{item}>"), F.array().cast(f"array<{kind}>")

        def up(reach, m):
            other = m["own"] == 0
            return (F.when(other, F.greatest(reach, m["e"])).otherwise(reach),
                    F.when(other | (reach <= m["s"]), F.array(m)).otherwise(none))

        def down(nearest, m):
            other = m["own"] == 0
            return (F.when(other, m["s"]).otherwise(nearest),
                    F.when(other | (nearest < m["e"]), gone).otherwise(F.array(m["x"])))

        left = scan_array(marks, F.lit(-1), up, item)
        return F.reverse(scan_array(F.reverse(left), F.lit(2**31 - 1), down, kind))

    few = lambda v: F.size(v["a"]).cast("long") * F.size(v["b"]) <= 4096
    return let(F.struct(spans.alias("a"), others.alias("b")), lambda v: F.when(few(v), pairs(v)).otherwise(sweep(v)))


def number_rows(df: DataFrame, part: list, order: list, chunk: Column, label: str) -> DataFrame:
    """Adds ``row_index``: 0-based number of a row within ``part``.

    Rows are ordered by (``chunk``, ``order``) inside a partition key.  Each
    window holds one chunk; chunk offsets come from a table of chunk counts.
    """
    d = materialize(df.withColumn("_chunk", chunk), label)
    counts = d.groupBy(*part, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*part, "_chunk").orderBy(*order)
    numbered = d.withColumn("_rn", F.row_number().over(w) - 1)
    return (numbered.join(offsets, [*part, "_chunk"])
            .withColumn("row_index", (F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_chunk", "_off", "_rn"))
