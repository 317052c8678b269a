"""Connected components of an edge table by alternating star contraction.

Each round sends every vertex's neighbours to its smallest neighbour (large
star), then links smaller ones among themselves (small star); labels only
shrink, and the rounds needed grow with the logarithm of the longest path.
A vertex's neighbours are pre-aggregated map-side and joined back; Spark
splits the join where a vertex has very many.  Edges that come as stars around
the smallest node of a block settle in two or three rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize

MAX_ROUNDS = 60


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of u and all its neighbours."""
    m = edges.groupBy("u").agg(F.min("v").alias("_min"))
    return edges.join(m, "u").select("u", "v", F.least("u", "_min").alias("m"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node of ``edges``; root is the smallest node."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    e = materialize(e, "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _smallest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            small.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        e = materialize(small, "edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
