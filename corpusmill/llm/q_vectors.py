"""Checked query: centroid clustering."""

from __future__ import annotations

from corpusmill.llm import centroids
from corpusmill.llm.common import read
from corpusmill.llm.registry import register

K, ROUNDS = 40, 5


def _assign(i: int) -> str:
    """CTE: every vector with the nearest centroid of table ``c<i>``."""
    return f"""
a{i} AS (SELECT rid, vec_id, v, arg_min(cl, (d, cl)) AS cl, min(d) AS d
         FROM (SELECT k.rid, k.vec_id, k.v, c.cl,
                      list_sum(list_transform(list_zip(k.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
               FROM kept k, c{i} c) GROUP BY 1, 2, 3)"""


def _update(i: int) -> str:
    """CTE: the centroids after round ``i``."""
    return f""",
s{i} AS (SELECT cl, pos, CAST(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS BIGINT) AS m
         FROM (SELECT cl, pos, sum(x) AS s, count(*) AS n
               FROM (SELECT cl, unnest(v) AS x, unnest(range({centroids.DIM})) AS pos FROM a{i}) GROUP BY 1, 2)),
c{i + 1} AS (SELECT c.cl, coalesce(s.c, c.c) AS c
             FROM c{i} c LEFT JOIN (SELECT cl, list(m ORDER BY pos) AS c FROM s{i} GROUP BY 1) s ON s.cl = c.cl),"""


SQL11 = f"""
WITH src AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS x
             FROM embeddings),
kept AS (SELECT rid, vec_id, list_transform(x, lambda e: CAST(floor(greatest(least(e * {centroids.SCALE},
                {centroids.BOUND}), -{centroids.BOUND})) AS BIGINT)) AS v
         FROM src WHERE len(x) = {centroids.DIM} AND len(list_filter(x, lambda e: e IS NOT NULL AND isfinite(e))) = {centroids.DIM}),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS cl, v AS c
       FROM (SELECT v, sha256('2:' || CAST(vec_id AS VARCHAR)) AS h FROM kept ORDER BY h NULLS LAST, v LIMIT {K})),
{"".join(_assign(i) + _update(i) for i in range(ROUNDS))}{_assign(ROUNDS)}
SELECT vec_id, a.cl AS "cluster", CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.cl) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cl = a.cl
"""


@register("op11_centroids", SQL11)
def op11(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return centroids.digest_columns(*centroids.cluster_vectors(vectors, k=K, rounds=ROUNDS))
