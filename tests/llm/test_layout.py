"""Sharding and packing: laws, brute-force optimum, awkward rows."""

import itertools
import zlib
from collections import Counter

import numpy as np

from corpusmill.llm import packing, sharding
from tests.llm import brute
from tests.llm.conftest import make_rows


def _check_shards(got, rows, n, slack):
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    load = Counter()
    for r in got:
        load[r.shard] += r["size"]
    mean = sum(load.values()) / n
    assert all(abs(load.get(s, 0) - mean) <= slack for s in range(n))
    for s in range(n):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shards_near_equal_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sharding.shard_records(df, 8).collect()
    _check_shards(got, rows, 8, max(len((t or "").encode()) for _, t in rows) + 16)


def test_shards_with_a_third_of_rows_equal(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 7)) for i in range(3000)]
    got = sharding.shard_records(spark.createDataFrame(rows, "doc_id long, text string"), 40, sample=500).collect()
    _check_shards(got, rows, 40, 120)
    # Copies are neighbours in key order: the shards that hold them are consecutive.
    copies = sorted({r.shard for r in got if r.doc_id % 3 == 0})
    assert copies == list(range(copies[0], copies[-1] + 1))


def test_shards_of_awkward_rows(docs, no_docs):
    rows = [r[:2] for r in make_rows()]
    got = sharding.shard_records(docs, 5).collect()
    _check_shards(got, rows, 5, max(len((t or "").encode()) for _, t in rows) + 16)
    assert sharding.shard_records(no_docs, 5).collect() == []


def test_splitters_are_weighted_quantiles():
    keys, w = np.arange(100), np.where(np.arange(100) < 10, 9.0, 1.0)
    assert list(sharding.choose_splitters(keys, w, 2)) == [9]


def _padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


def test_boundaries_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = sorted(rng.integers(0, 40, 25).tolist())
        distinct = sorted(set(lengths))
        counts = np.array([lengths.count(x) for x in distinct], float)
        ends = packing.optimal_boundaries(np.array(distinct, float), counts, counts * distinct, 4)
        got = [distinct[e] for e in ends]
        best = min(_padding(lengths, [*c, distinct[-1]]) for k in range(4) for c in itertools.combinations(distinct[:-1], k))
        assert len(got) <= 4 and _padding(lengths, got) == best


def _check_packing(got, rows, budget):
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((d, len(brute.words(t))) for d, t in rows)
    bounds = sorted({r.boundary for r in got})
    batches = {}
    for r in got:
        assert r.boundary == min(b for b in bounds if b >= r.n_tokens) and r.padding == r.boundary - r.n_tokens
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for b in batches.values():
        assert sorted(r.slot for r in b) == list(range(len(b)))
        assert len(b) * b[0].boundary <= budget or len(b) == 1
    for k in {k for k, _ in batches}:
        n = [len(batches[(k, i)]) for i in sorted(i for kk, i in batches if kk == k)]
        assert len(set(n[:-1])) <= 1 and n[-1] <= n[0]  # full batches, then the rest
    return sum(r.padding for r in got)


def test_packing_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    pads = [_check_packing(packing.pack(df, buckets=k).collect(), rows, packing.BUDGET) for k in (1, 4, 12)]
    assert pads[0] > pads[1] > pads[2]


def test_packing_of_awkward_rows(docs, no_docs):
    _check_packing(packing.pack(docs, buckets=3, budget=64).collect(), [r[:2] for r in make_rows()], 64)
    assert packing.pack(no_docs).collect() == []


def test_length_bins_are_monotone(spark):
    df = spark.range(0, 60000).select("id", packing.length_bin(packing.F.col("id")).alias("b")).orderBy("id").collect()
    b = [r.b for r in df]
    assert b == sorted(b) and b[:1024] == list(range(1024)) and len(set(b)) < 2700
