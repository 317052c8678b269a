"""Sources and sinks: CSV round trip (FIXTURES 4.7), JSON field scan, gzip
fallback, build write and reload, config, vocabulary reuse."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import files

TRICKY = ['He said "hi", ok', "a\rb", 'back\\slash "q\\" x', "plain"]


@pytest.mark.parametrize("compress", [False, True])
def test_csv_round_trip(spark, tmp_path, compress):
    df = spark.createDataFrame([("train", i, 0, t) for i, t in enumerate(TRICKY)] + [("train", 9, 1, "b"), ("train", 9, 0, "a")],
                               "split string, article_id long, sent_idx long, text string")
    path = str(tmp_path / "s")
    files.write_sentences(df, path, fmt="csv", compress=compress)
    back = files.read_sentences(spark, path, fmt="csv")
    got = sorted((r.article_id, r.sent_idx, r.text) for r in back.collect())
    assert got == [(i, 0, t) for i, t in enumerate(TRICKY)] + [(9, 0, "a"), (9, 1, "b")]


def test_split_files_plain_or_gzip(spark, tmp_path):
    import csv
    import io
    for split, gz in (("train", False), ("val", True)):
        buf = io.StringIO()
        w = csv.writer(buf, lineterminator="\n")
        w.writerow(["article_id", "text"])
        for i, t in enumerate(TRICKY):
            w.writerow([i, t])
        data = buf.getvalue().encode()
        name = tmp_path / f"{split}_data.csv"
        if gz:
            (tmp_path / f"{split}_data.csv.gz").write_bytes(gzip.compress(data))
        else:
            name.write_bytes(data)
    df = files.read_split_files(spark, str(tmp_path), {"train": 1, "val": 0.1})
    got = sorted((r.split, r.article_id, r.text) for r in df.collect())
    assert got == sorted((s, i, t) for s in ("train", "val") for i, t in enumerate(TRICKY))


def test_json_field(spark, tmp_path):
    p = tmp_path / "train_data.json"
    p.write_text(json.dumps({"data": [{"article_id": 1, "text": "a b"}, {"article_id": 2, "text": "c"}]}))
    df = files.read_json_field(spark, str(p))
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a b"), (2, "c")]


def test_build_write_reload_and_config(spark, tmp_path):
    from conftest import SF001
    from corpusmill.operators.sentences import articles_from_documents
    from corpusmill.plans.build_splits import build_and_reload, build_splits, write_build
    from corpusmill.sources.tables import table
    arts = articles_from_documents(table(spark, SF001, "documents", "doc_id", "source", "text"))
    out = str(tmp_path / "build")
    back = build_and_reload(arts, out, {"train": 0.05, "val": 0.01})
    b = build_splits(arts, {"train": 0.05, "val": 0.01})
    want = sorted(map(tuple, b.sentences.select("split", "article_id", "sent_idx", "text").collect()))
    assert sorted(map(tuple, back.select("split", "article_id", "sent_idx", "text").collect())) == want
    assert files.read_config(spark, out + "/config")["split_sizes_MB"] == {"train": 0.05, "val": 0.01}
    man = files.csv_reader(spark, files.MANIFEST_SCHEMA).csv(out + "/articles")
    assert man.count() == b.manifest.count()
    # reuse policy: an existing build is kept
    b2 = build_splits(arts, {"train": 0.01})
    write_build(b2, out, force_rebuild=False)
    assert files.read_config(spark, out + "/config")["split_sizes_MB"] == {"train": 0.05, "val": 0.01}


def test_vocab_load_or_build(spark, tmp_path):
    from corpusmill.operators import vocab as V
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("[PAD]", 0, "special")], "token string, id int, kind string")
    p = str(tmp_path / "vocab")
    a = V.load_or_build_vocab(spark, p, build)
    b = V.load_or_build_vocab(spark, p, build)
    assert a.count() == b.count() == 1 and len(calls) == 1
