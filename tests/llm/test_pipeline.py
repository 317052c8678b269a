"""The pipeline's stages against plain Python on the stage's own input."""

import itertools
import random
import re

import pytest

import corpus_pipeline as cp
from corpusmill.llm import decontam, exact_dedup, ngram_join, packing, quality
from tests.llm import brute
from tests.llm.conftest import make_rows

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Every stage's input and output over sf0.01 plus awkward rows."""
    at = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    extra = spark.createDataFrame([(None if d is None else 10_000_000 + i, t, lang, s, 0)
                                   for i, (d, t, lang, s) in enumerate(make_rows())], docs.schema)
    docs.unionByName(extra).write.parquet(f"{at}/0")
    out = [spark.read.parquet(f"{at}/0")]
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, out[-1], SF01).write.parquet(f"{at}/{i + 1}")
        out.append(spark.read.parquet(f"{at}/{i + 1}"))
    return out


def _rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def test_columns_are_those_of_documents(results):
    assert all(r.columns == results[0].columns for r in results[:-1])


def test_quality_keeps_clean_documents(spark, results):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    before, after = _rows(results[0]), {d for d, _ in _rows(results[1])}
    good = [d for d, _ in before if labels.get(d) == 1]
    bad = [d for d, _ in before if labels.get(d) == 0]
    assert sum(d in after for d in good) >= 0.98 * len(good) and sum(d in after for d in bad) <= 0.2 * len(bad)
    model = quality.train(results[0], spark.read.parquet(f"{SF01}/labels.parquet"))
    scored = quality.classify(results[0], model).filter("predicted = 1").count()
    assert scored == results[1].count()


def test_exact_dedup_keeps_one_of_each_text(results):
    groups = {}
    for d, t in _rows(results[1]):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, d))
    assert sorted(str(min(g)[3]) for g in groups.values()) == sorted(str(d) for d, _ in _rows(results[2]))


def test_ngram_join_keeps_one_of_each_group(results):
    rows = [r for r in _rows(results[2]) if r[0] is not None]
    want = brute.components(rows)
    assert len({d for d, _ in rows}) == len(rows)
    kept = [d for d, _ in _rows(results[3]) if d is not None]
    assert sorted(kept) == sorted(d for d, (_, c) in want.items() if d == c)


def test_decontamination_drops_what_the_operator_names(spark, results):
    items = spark.read.parquet(f"{SF01}/benchmark.parquet")
    grams = set()
    for r in items.collect():
        w = brute.words(r.text.lower())
        grams |= {tuple(w[i:i + decontam.WINDOW]) for i in range(len(w) - decontam.WINDOW + 1)}
    before, after = _rows(results[3]), _rows(results[4])
    for d, t in after:
        w = brute.words((t or "").lower())
        assert not any(tuple(w[i:i + decontam.WINDOW]) in grams for i in range(len(w) - decontam.WINDOW + 1))
    named = {r.doc_id for r in decontam.contaminated(results[3], items).collect()}
    assert after == [r for r in before if r[0] not in named] and named


def test_packing_places_all_that_is_left(results):
    want = sorted((str(d), len(brute.words(t))) for d, t in _rows(results[4]))
    assert sorted((str(r.doc_id), r.n_tokens) for r in results[5].collect()) == want


def test_run_and_empty_table(spark, results, tmp_path):
    assert cp.run(spark, SF01).columns == results[5].columns
    empty = spark.read.parquet(f"{SF01}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, SF01)
        assert empty.collect() == []


def test_scans_cut_differently_drop_the_same_rows(spark, tmp_path, monkeypatch):
    """Between two scans of a stage the files are packed into other partitions."""
    rng = random.Random(5)

    def text(n):
        return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))

    texts = [text(40 + 5 * i) for i in range(60)]
    rows = list(enumerate(texts)) + [(100 + i, t) for i, t in enumerate(texts[:20])]      # copies
    rows += [(200 + i, t + " changed") for i, t in enumerate(texts[20:40])]               # near copies
    rows += [(300 + i, text(30 + i) + " " + texts[0][:200]) for i in range(5)]            # benchmark passages
    sf = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rng.shuffle(rows)
    spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], schema).repartition(25).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, texts[0][:200])], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")}
    calls = itertools.count()

    def recut(write):
        def run(df, label):
            out = write(df, label)
            spark.conf.set("spark.sql.files.minPartitionNum", (1, 3, 40)[next(calls) % 3])
            return out
        return run

    for module in (cp, exact_dedup, ngram_join):
        monkeypatch.setattr(module, "materialize", recut(module.materialize))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        left = [sorted(r.doc_id for r in stage(spark, docs, sf).collect())
                for stage in (cp.exact_dedup_stage, cp.ngram_join_stage, cp.decontamination_stage)]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    own, copies, near, leaks = (set(range(a, b)) for a, b in ((0, 60), (100, 120), (200, 220), (300, 305)))
    assert left == [sorted(own | near | leaks), sorted(own | leaks), sorted((own | copies | near) - {0, 100})]
