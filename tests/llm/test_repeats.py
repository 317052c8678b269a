"""Repeated passages against counting every window."""

import random

import numpy as np
import pytest

from corpusmill.llm import repeats as rp
from tests.llm import brute
from tests.llm.conftest import make_rows


def _check(df, rows, **kw):
    got = rp.remove_repeats(df, **kw).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.repeats(rows)
    return got


def _passages(seed=2, n=150):
    """Documents that share passages of 30 to 70 words, some cut, some twice in one."""
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(500)]
    shared = [[rnd.choice(vocab) for _ in range(rnd.randint(30, 70))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            p = shared[min(rnd.randrange(12), 5)]
            a, b = rnd.choice([(0, len(p)), (3, len(p)), (0, len(p) - 4), (10, 44)])
            at = rnd.randint(0, len(t))
            t[at:at] = p[a:b]
        if i % 17 == 0:
            t += ["In."] * rnd.randint(30, 60)
        rows.append((i, rnd.choice([" ", "\n", "  \t"]).join(t)))
    return rows + [(n, rows[3][1]), (n + 1, rows[3][1].replace(" ", "\n")), (n + 2, "é ñ " * 40)]


@pytest.mark.parametrize("hot", [None, 1, 5])
def test_shared_passages(spark, hot):
    rows = _passages()
    _check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, hot=hot)


def test_location_in_overlapping_and_periodic_pieces():
    rng = np.random.default_rng(1)
    words = [b"w%d" % x for x in rng.integers(0, 9, 200)]
    pieces = [b" ".join(words[a:a + n]) for a, n in ((0, 60), (5, 40), (20, 35), (100, 50))]
    pieces.append(b" ".join([b"a", b"b"] * 30))
    got = list(zip(*(x.tolist() for x in rp.locate(pieces, [None] * 5))))
    assert got == [(0, 5, 50), (1, 0, 40), (2, 0, 35), (4, 0, 60)]
    assert [x.tolist() for x in rp.locate(pieces[3:4], [None])] == [[], [], []]
    assert [x.tolist() for x in rp.locate(pieces[3:4], [[2, 3]])] == [[0], [2], [36]]


def test_generated_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _check(df, [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_awkward_rows(spark, docs, no_docs):
    rows = [r[:2] for r in make_rows() if r[0] not in (0, 7, None)]
    _check(docs.filter("doc_id > 0 AND doc_id != 7"), rows)
    got = rp.remove_repeats(docs).collect()
    assert len(got) == len(make_rows()) and sum(r.doc_id == 0 for r in got) == 2
    assert rp.remove_repeats(no_docs).collect() == []


def test_kept_text(spark):
    words = [f"x{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, "own " + " ".join(words[20:60]) + " end")]
    got = {r.doc_id: r for r in rp.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()}
    assert got[2].kept_text == "own end" and got[1].kept_text == " ".join(words[:20] + words[60:])


def test_a_third_of_rows_share_a_passage(spark):
    p = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"{i} {p} {i}" if i % 3 == 0 else " ".join(f"{i}w{j}" for j in range(40))) for i in range(300)]
    got = _check(spark.createDataFrame(rows, "doc_id long, text string"), rows, hot=20)
    assert all(r.n_removed == (50 if r.doc_id % 3 == 0 else 0) for r in got)


def test_null_and_repeated_ids(spark):
    """Ids that tell nothing: results and time as with ids of their own."""
    p = " ".join(f"p{i}" for i in range(45))
    texts = [f"{p} {' '.join(f'{i}w{j}' for j in range(20))}" for i in range(600)] + ["few words"] * 300
    want = sorted(brute.repeats(list(enumerate(texts))).values())
    for ids in ([None] * 900, [5] * 900, [None if i % 2 else i % 7 for i in range(900)]):
        got = rp.remove_repeats(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), hot=100).collect()
        assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
        assert sorted(str(r.doc_id) for r in got) == sorted(map(str, ids))


def test_blocks_of_hot_windows(spark):
    rng = np.random.default_rng(4)
    words = [b"w%d" % x for x in rng.integers(0, 40, 90)]
    rows = [(i, b" ".join(words[a:a + 50])) for i, a in enumerate([0, 3, 3, 40, 17, 0])]
    h, row, place = rp._windows_of([w for _, w in rows])
    df = spark.createDataFrame([(i, 1, i, 0, bytearray(w)) for i, w in rows], "rid long, anchor long, cls long, first long, words binary")
    got = {r.cls: r.windows for r in rp.confirm_hot(df.repartition(3)).collect()}
    for i, _ in rows:
        want = [int(p) for x, r, p in zip(h, row, place) if r == i and (h == x).sum() > 1]
        assert got.get(i, []) == want
