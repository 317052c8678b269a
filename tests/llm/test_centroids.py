"""Centroid clustering against plain Python integers; awkward vectors."""

import hashlib
import math
import random

import numpy as np

from corpusmill.llm import centroids as C

BAD = [None, [], [0.5] * 63, [0.5] * 65, [None] + [0.5] * 63, [math.nan] + [0.5] * 63, [math.inf] * 64]
SCHEMA = "vec_id long, embedding array<float>, label int, planes string, cluster int, norm long"


def _brute(rows, k=40, rounds=5):
    bound = float(C.BOUND)
    kept = [(i, [math.floor(min(max(float(x) * 256, -bound), bound)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cent = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cent))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, vs in groups.items():
            cent[n] = [sum(col) // len(vs) for col in zip(*vs)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    own = {}
    for _, n, d in out:
        own[n] = own.get(n, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, n, d, own[n], sum(own.values()), sha[n]) for i, n, d in out), key=str)


def _run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "p", 2, 3) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in C.digest_columns(*C.cluster_vectors(df, **kw)).collect()), key=str)


def _vec(rng, scale=1.0):
    return [float(np.float32(rng.gauss(0, scale))) for _ in range(64)]


def test_planes_round_trip_and_dots():
    rng = np.random.default_rng(3)
    u, c = rng.integers(0, 1 << 28, (70, 64)), rng.integers(0, 1 << 28, (5, 64))
    x, y = C.pack(u, 28), C.pack(c, 28)
    assert (C.unpack(x) == u).all()
    assert (C.dot_products(x, y) == u @ c.T).all()


def test_matches_brute_force_with_awkward_rows(spark):
    rng = random.Random(5)
    same = _vec(rng)
    rows = [(i, _vec(rng)) for i in range(120)] + [(200 + i, same) for i in range(150)]  # a hot cluster
    rows += [(7, _vec(rng)), (7, _vec(rng)), (3, rows[3][1]), (None, _vec(rng)), (None, same)]  # repeated and null ids
    rows += [(300 + i, v) for i, v in enumerate(BAD)] + [(None, None)]
    assert _run(spark, rows) == _brute(rows)


def test_few_vectors_ties_and_huge_components(spark):
    rows = [(1, [0.0] * 64), (2, [0.0] * 64), (None, [1.0] * 64), (4, [3e38] * 64), (5, [-3e38] + [0.25] * 63)]
    assert _run(spark, rows, rounds=2) == _brute(rows, rounds=2)
    one = [(9, [0.1] * 64)]
    assert _run(spark, one) == _brute(one)


def test_no_vectors(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(i, v) for i, v in enumerate(BAD)]) == []
