"""Quality network: gradient, whole texts, held-out accuracy, awkward rows."""

import zlib

import numpy as np

from corpusmill.llm import quality as q
from tests.llm.conftest import make_rows


def test_gradient_matches_differences():
    net, data = q.ByteCnn(1), q.to_bytes("Some words here, " * 40)
    for p in net.params():
        p[...] = p.astype(np.float32)

    def loss():
        z = net.logit(data)
        return np.log1p(np.exp(-z))

    grads = [np.zeros_like(p) for p in net.params()]
    net.gradient(data, 1.0, 1.0, grads)
    for p, g in zip(net.params(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, eps = p[at].copy(), 1e-2
        p[at] = old + eps
        up = loss()
        p[at] = old - eps
        down = loss()
        p[at] = old
        assert abs((up - down) / (2 * eps) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_whole_text_is_read_whatever_the_block(monkeypatch):
    net = q.ByteCnn(2)
    data = np.random.default_rng(0).integers(32, 127, 20_000).astype(np.uint8)
    whole = net.logit(data)
    monkeypatch.setattr(q, "BLOCK", 1024)
    assert abs(net.logit(data) - whole) < 1e-4
    changed = data.copy()
    changed[-200:] = ord("#")
    assert net.logit(changed) != whole


def test_awkward_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, text int")
    model = q.train(docs, labels)
    got = q.classify(docs, model).collect()
    assert len(got) == len(make_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= .7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    same = {}
    for r in got:
        text = dict((k[0], k[1]) for k in make_rows() if k[0] != 0 and k[0] is not None).get(r.doc_id)
        if text is not None and r.doc_id not in (0, 7, None):
            assert same.setdefault(text, r.score) == r.score  # lang, source and id are no inputs
    assert q.classify(no_docs, model).collect() == []
    assert {r.score for r in q.classify(docs, q.train(docs, labels.limit(0))).collect()} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = q.classify(docs, q.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    good, bad = [r for r in out if r.quality == 1], [r for r in out if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)
    assert sum(r.predicted for r in bad) <= 0.1 * len(bad)
    s0, s1 = np.sort([r.score for r in bad]), np.array([r.score for r in good])
    assert np.searchsorted(s0, s1).mean() / len(s0) > 0.99  # area under the curve
