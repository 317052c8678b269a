"""N-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest

from corpusmill.llm import ngram_join as nj
from corpusmill.llm.words import column_bytes, words_of
from tests.llm import brute
from tests.llm.conftest import make_rows


def _check(df, rows):
    got = df.collect()
    want = brute.components(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    size = {}
    for r in got:
        size[r.component_id] = size.get(r.component_id, 0) + 1
    assert all(r.component_size == size[r.component_id] for r in got)


def _near_copies(n, words=120, seed=1, groups=4):
    """Groups of near copies around the threshold, sharing common passages."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    common = [rnd.choice(vocab) for _ in range(30)]
    rows = []
    for g in range(groups):
        base = [rnd.choice(vocab) for _ in range(words)] + common
        for i in range(n):
            t = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 4, 6, 9])):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            rows.append((g * n + i, " ".join(t).title() if i % 5 == 0 else "  ".join(t)))
    rnd.shuffle(rows)
    return rows


def test_words_match_the_regex():
    import pyarrow as pa
    texts = [t for _, t, *_ in make_rows()] + ["x" * 2_000_000 + " y " + "z " * 600_000]
    seen = {}
    for text, data in zip(texts, column_bytes(pa.array(texts))):
        s, e, h = words_of(data, fold=True)
        want = [w.lower() if w.isascii() else None for w in brute.words(text)]
        assert len(want) == len(h)
        for w, v in zip(want, h.tolist()):
            if w is not None:
                assert seen.setdefault(w, v) == v
    assert len(set(seen.values())) == len(seen)


def test_block_search_matches_all_pairs():
    rng = np.random.default_rng(4)
    for _ in range(30):
        base = rng.choice(400, 60, replace=False)
        sets = []
        for _ in range(40):
            keep = base[rng.random(60) < rng.choice([0.8, 0.9, 0.97])]
            sets.append(np.unique(np.concatenate([keep, rng.choice(400, rng.integers(1, 12))])).astype(np.uint64))
        root = list(range(len(sets)))

        def comps(pairs):
            root = list(range(len(sets)))
            for a, b in pairs:
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
            return root

        want = [(a, b) for b in range(len(sets)) for a in range(b)
                if nj.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))]
        got = nj.spanning_links(sets)
        assert set(got) <= set(want) and comps(got) == comps(want) and len(got) < len(sets)


@pytest.mark.parametrize("block", [nj.BLOCK_SHINGLES, 3000])
def test_near_copies_around_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(nj, "BLOCK_SHINGLES", block)
    rows = _near_copies(60)
    _check(nj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)), rows)


def test_generated_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _check(nj.jaccard_components(df), [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_awkward_rows(docs, no_docs, spark):
    rows = [r[:2] for r in make_rows() if r[0] not in (0, 7, None)]
    _check(nj.jaccard_components(docs.filter("doc_id > 0 AND doc_id != 7")), rows)
    # Repeated rows and null ids: same set, same component.
    got = nj.jaccard_components(docs).collect()
    assert len(got) == len(make_rows())
    assert [r.component_id for r in got if r.doc_id is None] == [4]
    assert {r.component_id for r in got if r.doc_id in (0, 100)} == {0}
    assert sorted(r.component_id for r in got if r.doc_id == 7) == [2, 7]
    assert nj.jaccard_components(no_docs).collect() == []


def test_a_third_of_rows_in_one_group(spark):
    rows = [(i, f"the same words are here in each of these many rows {i % 2}" if i % 3 == 0 else f"text number {i} has {i * 7} own {i * 3} words {i}")
            for i in range(300)]
    _check(nj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_null_and_repeated_ids_with_many_texts(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    texts = [f"{base} {i % 40}" for i in range(800)] + [f"t{i} u{i} v{i} w{i} x{i} y{i}" for i in range(1200)]
    for ids in ([None] * 2000, [9] * 2000, [None if i % 3 else 2**53 + 1 + i for i in range(2000)]):
        got = nj.jaccard_components(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")).collect()
        known = [i for i in ids[:800] if i is not None]
        assert sorted(r.component_size for r in got) == [1] * 1200 + [800] * 800
        assert {r.component_id for r in got if r.component_size == 800} == {min(known) if known else None}


def test_one_group_of_near_copies_is_linear():
    import time

    import numpy as np
    rng = np.random.default_rng(0)
    base, times = rng.integers(0, 1 << 60, 44), []
    for m in (2000, 8000):
        sets = []
        for _ in range(m):
            b, k = base.copy(), rng.integers(0, 5)
            b[rng.integers(0, 44, k)] = rng.integers(0, 1 << 60, k)
            sets.append(np.unique(b).astype(np.uint64))
        start = time.perf_counter()
        assert len(nj.spanning_links(sets)) == m - 1
        times.append(time.perf_counter() - start)
    assert times[1] < 5 and times[1] < 10 * times[0]
