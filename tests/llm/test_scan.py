"""Base spans of PII and secrets against plain Python; the added layers."""

from collections import Counter

import pandas as pd

from corpusmill.llm import pii, secrets
from tests.llm import brute
from tests.llm.conftest import make_rows

SF01 = "/root/testdata/sf0.01"


def _sf_rows():
    d = pd.read_parquet(f"{SF01}/documents.parquet")
    return list(zip(d.doc_id, d.text))


def _check_pii(got, rows):
    want = Counter()
    for d, t in rows:
        s = brute.pii(t)
        n = Counter(k for k, _, _ in s)
        want[(d, n["email"], n["ip"], n["card"], n["phone"], brute.sha(brute.join(s)))] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    by_id = {d: set(brute.join(brute.pii(t)).split(",")) - {""} for d, t in rows}
    for r in got:
        spans = set(r.spans.split(",")) - {""}
        assert by_id[r.doc_id] <= spans or r.doc_id in (0, 7)
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added


def test_pii_base_spans_match_brute_force(docs):
    _check_pii(pii.digest_columns(pii.find_pii(docs)).collect(), [r[:2] for r in make_rows()])


def test_pii_on_generated_documents(spark):
    got = pii.digest_columns(pii.find_pii(spark.read.parquet(f"{SF01}/documents.parquet"))).collect()
    _check_pii(got, _sf_rows())


def test_pii_empty_table(no_docs):
    assert pii.digest_columns(pii.find_pii(no_docs)).collect() == []


def test_em_recovers_planted_reliabilities():
    # Labeler 1 is right 90 % of the time, 2 abstains mostly, 3 is noise.
    hist = []
    for truth, prior in ((1, 300), (-1, 700)):
        for v1, p1 in ((truth, .9), (-truth, .1)):
            for v2, p2 in ((0, .6), (truth, .38), (-truth, .02)):
                for v3, p3 in ((1, .5), (-1, .5)):
                    hist.append(((v1, v2, v3), (truth == 1, 0), prior * p1 * p2 * p3))
    post = pii.expectation_maximisation(hist)
    for (v, _, _), p in zip(hist, post):
        if v[0] == v[1]:
            assert (p > .5) == (v[0] == 1)
    w = pii.fit_classifier(hist, post)
    assert w[1] > w[3] and w[4] < w[6]


def test_classifier_adds_loose_spans_with_support(spark):
    rows = [(i, f"please call phone 212-555-{i:04d} today") for i in range(100, 160)]
    rows += [(1000 + i, f"isbn 000-200-{i:04d} version") for i in range(100, 160)]
    got = pii.digest_columns(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert all((r.n_added == 1) == (r.doc_id < 1000) for r in got)


def _check_secrets(got, rows):
    want = Counter()
    for d, t in rows:
        s = brute.secrets(t)
        n = Counter(k for k, _, _ in s)
        want[(d, n["assign"], n["access"], n["hex"], brute.sha(brute.join(s)))] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want


def test_secret_base_spans_match_brute_force(docs):
    _check_secrets(secrets.digest_columns(secrets.scan_secrets(docs)).collect(), [r[:2] for r in make_rows()])


def test_secrets_on_generated_documents(spark):
    got = secrets.digest_columns(secrets.scan_secrets(spark.read.parquet(f"{SF01}/documents.parquet"))).collect()
    _check_secrets(got, _sf_rows())


def test_secrets_empty_table(no_docs):
    assert secrets.digest_columns(secrets.scan_secrets(no_docs)).collect() == []


def test_ownership_separates_copied_from_live(spark):
    key = "ghp_abcdefghijklmnop1234"
    rows = [(i, f"use {key} here", "en", f"owner{i}") for i in range(5)]
    rows += [(10, "use ghp_zyxwvutsrqponm9876 here", "en", "owner1"), (11, "use ghp_zyxwvutsrqponm9876 again", "en", "owner1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in secrets.digest_columns(secrets.scan_secrets(df)).collect()}
    assert all(got[i].spans == "" and got[i].n_copied == 1 and got[i].n_live == 0 for i in range(5))
    assert got[10].spans == "vendor:4:26" and got[11].n_live == 1


def test_key_held_by_a_third_of_all_rows(spark):
    rows = [(i, "token = abcdefabcdefabcdef0123" if i % 3 == 0 else f"token = {i:030x}", "en", f"o{i % 9}")
            for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = secrets.digest_columns(secrets.scan_secrets(df)).collect()
    assert len(got) == 900 and all((r.n_copied == 2) == (r.doc_id % 3 == 0) for r in got)


def test_long_shapes_are_candidates(spark):
    word = "x" * 150
    rows = [(1, f"https://user:{word}@host.example/", "en", "o1"), (2, f"https://{word}:{word}@h/", "en", "o2"),
            (3, "-----BEGIN " + "VERY " * 20 + "PRIVATE KEY-----", "en", "o3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.spans for r in secrets.digest_columns(secrets.scan_secrets(df)).collect()}
    assert got[1] == "url:5:164" and got[2] == "url:5:310" and got[3].startswith("pem:0:")
    found = pii.find_pii(spark.createDataFrame([(1, "a@" + ".".join("b" * 70 for _ in range(12)))], "doc_id long, text string"))
    assert [(s.s, s.e) for s in found.first().base] == [(0, 853)]


def test_copies_in_many_repositories_are_not_live(spark):
    key = "ghp_abcdefghijklmnop1234"
    rows = [(i, f"use {key} here", f"l{i}", "owner") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = secrets.digest_columns(secrets.scan_secrets(df)).collect()
    assert all((r.n_live, r.n_copied, r.owners, r.repos, r.spans) == (0, 1, 1, 5, "") for r in got)


def test_very_many_matches_in_one_text(spark):
    """Near linear in the matches of a text; spans as in plain Python."""
    import time
    times = []
    for n in (10000, 40000):
        text = " ".join(f"{i:016x}" for i in range(n)) + " " + "1 " * n
        df = spark.createDataFrame([(1, text, "en", "o")], "doc_id long, text string, lang string, source string")
        start = time.perf_counter()
        _check_secrets(secrets.digest_columns(secrets.scan_secrets(df)).collect(), [(1, text)])
        _check_pii(pii.digest_columns(pii.find_pii(df)).collect(), [(1, text)])
        times.append(time.perf_counter() - start)
    assert times[1] < 5 * times[0]


def test_apart_many_and_few(spark):
    import random

    from pyspark.sql import functions as F

    from corpusmill.llm.common import apart
    rnd = random.Random(3)
    kind = "struct<s:int,e:int>"
    for n in (20, 400):
        a = sorted({(s, s + rnd.randint(1, 6)) for s in rnd.sample(range(20 * n), n)})
        b = sorted({(s, s + rnd.randint(1, 6)) for s in rnd.sample(range(20 * n), n)})
        df = spark.createDataFrame([(a, b)], f"a array<{kind}>, b array<{kind}>")
        got = [tuple(x) for x in df.select(apart(F.col("a"), F.col("b"), kind).alias("x")).first().x]
        assert got == [x for x in a if not any(o[0] < x[1] and o[1] > x[0] for o in b)]
