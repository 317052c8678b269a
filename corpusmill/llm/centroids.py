"""Centroid clustering on bit planes.

Vectors become integers floor(256 * x), shifted by the least component of the
table so that none is negative.  Bit b of all 64 components is packed into one
uint64, the bit plane b; the dot product of a vector and a centroid is then
``sum over planes i, j of 2^(i+j) * popcount(X_i AND C_j)``, an exact integer,
and ``|x|^2 - 2 x.c + |c|^2`` is the exact squared distance (which the shift
does not change).

1. One aggregate finds the least and the largest component, one top-k the
   starting centroids.  Planes are written once, about a third of the vectors.
2. A round sends the centroid planes (``k`` x planes words, whatever the table's
   size) with the task; each task adds up its own vectors per centroid, so a
   round shuffles ``k`` rows a task, and a cluster with most of the vectors costs
   no more than others.  The driver receives ``k`` x 64 sums.
3. After the last round, one more scan assigns; the sums per cluster come back
   the same way.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component are left out.  A component beyond +-2^27 counts as that
bound, so that every distance fits a long.  Ids decide the starting centroids, repeated ids
in the order of their components; null ids come after all others.  Equal vectors and
repeated rows are rows like others; equal distances go to the smaller number.
With fewer than ``k`` vectors there are as many centroids; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize

DIM = 64
SCALE = 256
BOUND = 1 << 27
# Vectors whose distances to all centroids are held at once.
BLOCK = 2048


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<int>) of the vectors that are kept."""
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    whole = (F.size("x") == DIM) & F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform("x", lambda e: F.floor(F.least(F.greatest(e * SCALE, F.lit(-float(BOUND))),
                                                        F.lit(float(BOUND)))).cast("int"))
    return src.filter(F.col("x").isNotNull() & whole).select("vec_id", scaled.alias("v"))


def first_centroids(ints: DataFrame, k: int, salt: str) -> list:
    """The ``k`` vectors with the smallest hashes of their ids (k rows to the driver)."""
    h = F.sha2(F.concat(F.lit(salt + ":"), F.col("vec_id").cast("string")), 256)
    top = ints.select("v", h.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return [list(r.v) for r in top]


def pack(u: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes (rows x planes, uint64) of rows of 64 non-negative integers."""
    out = np.empty((len(u), planes), np.uint64)
    for b in range(planes):
        bits = ((u >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def unpack(x: np.ndarray) -> np.ndarray:
    """The integers of rows of bit planes; the inverse of ``pack``."""
    u = np.zeros((len(x), DIM), np.int64)
    for b in range(x.shape[1]):
        bits = np.unpackbits(np.ascontiguousarray(x[:, b:b + 1]).view(np.uint8), axis=1, bitorder="little")
        u += bits.astype(np.int64) << b
    return u


def dot_products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of rows given as bit planes, by weighted AND-popcounts."""
    planes = x.shape[1]
    dots = np.zeros((len(x), len(c)), np.int64)
    for weight in range(2 * planes - 1):
        same = np.zeros(dots.shape, np.uint16)  # at most 64 a pair of planes
        for i in range(max(0, weight - planes + 1), min(planes, weight + 1)):
            same += np.bitwise_count(x[:, i, None] & c[None, :, weight - i])
        dots += same.astype(np.int64) << weight
    return dots


def nearest(x: np.ndarray, norm: np.ndarray, c: np.ndarray, c_norm: np.ndarray):
    """(number of the nearest centroid, squared distance) of each row."""
    d = norm[:, None] - 2 * dot_products(x, c) + c_norm[None, :]
    best = d.argmin(axis=1)  # the first of equal ones
    return best, d[np.arange(len(d)), best]


def _blocks(batch, at: int, planes: int):
    """(planes, norms) of a batch in blocks; the planes are one binary column."""
    raw = np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint64).reshape(-1, planes)
    norm = batch.column(at + 1).to_numpy()
    for i in range(0, len(raw), BLOCK):
        yield raw[i:i + BLOCK], norm[i:i + BLOCK]


def _pack(low: int, planes: int):
    schema = pa.schema([("vec_id", pa.int64()), ("planes", pa.binary()), ("norm", pa.int64())])

    def run(batches):
        for batch in batches:
            v = batch.column(1)
            u = v.flatten().to_numpy().astype(np.int64).reshape(len(v), DIM) - low
            rows = pack(u, planes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array((u * u).sum(axis=1))],
                schema=schema)

    return run


def _sums(c: np.ndarray, planes: int):
    """Per task: count and component sums of the vectors nearest to each centroid."""
    packed, c_norm = pack(c, planes), (c * c).sum(axis=1)

    def run(batches):
        count, total = np.zeros(len(c), np.int64), np.zeros((len(c), DIM), np.int64)
        for batch in batches:
            for x, norm in _blocks(batch, 1, planes):
                best, _ = nearest(x, norm, packed, c_norm)
                count += np.bincount(best, minlength=len(c))
                u = unpack(x)
                order = np.argsort(best, kind="stable")
                at = np.flatnonzero(np.diff(best[order], prepend=-1))
                total[best[order][at]] += np.add.reduceat(u[order], at, axis=0)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(count[met]),
             pa.array(total[met].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def _assign(c: np.ndarray, planes: int):
    packed, c_norm = pack(c, planes), (c * c).sum(axis=1)
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches):
        for batch in batches:
            done = [nearest(x, norm, packed, c_norm) for x, norm in _blocks(batch, 1, planes)]
            if done:
                best, dist = (np.concatenate(z) for z in zip(*done))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(best.astype(np.int32)), pa.array(dist)], schema=schema)

    return run


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 40,
                    rounds: int = 5, salt: str = "2") -> tuple:
    """(assigned, centroids): vec_id, cluster, distance of every kept vector, and the final integer centroids."""
    ints = integer_vectors(vectors, id_col, vec_col)
    low, high = ints.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    spark = vectors.sparkSession
    if low is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    planes = max(1, int(high - low).bit_length())
    packed = materialize(ints.mapInArrow(_pack(low, planes), "vec_id long, planes binary, norm long"), "planes")
    c = np.array(first_centroids(ints, k, salt), np.int64) - low
    for _ in range(rounds):
        sums = packed.mapInArrow(_sums(c, planes), "cluster int, n long, sums array<long>")
        # One row a task and centroid; wide numbers, since a sum over all vectors may pass a long.
        wide = sums.select("cluster", F.col("n").cast("decimal(38,0)").alias("n"), F.posexplode("sums").alias("at", "s"))
        rows = wide.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        for r in rows:  # k x 64 of them
            c[r.cluster, r.at] = int(r.s) // int(r.n)
    assigned = packed.mapInArrow(_assign(c, planes), "vec_id long, cluster int, distance long")
    return assigned, (c + low).tolist()


def digest_columns(assigned: DataFrame, centroids: list) -> DataFrame:
    """vec_id, cluster, distance, and each cluster's inertia and centroid digest."""
    assigned = materialize(assigned, "assigned")
    # One row a centroid: their number is a parameter.
    own = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    side = [(i, own[i], sum(own.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids) if i in own]
    side = assigned.sparkSession.createDataFrame(
        side, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(side), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
