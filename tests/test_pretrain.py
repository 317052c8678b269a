"""The pretraining chain and versioned outputs."""

from pyspark.sql import functions as F

from corpusmill.operators.sentences import articles_from_documents
from corpusmill.plans.pretrain import prepare_pretraining, restored_text
from corpusmill.sources.tables import table
from corpusmill.sources.versioned import build_or_read

SHARES = {"train": 0.6, "val": 0.2, "test": 1.0}


def test_versioned_output(spark, tmp_path):
    root, calls = str(tmp_path), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    first = build_or_read(spark, root, "x", {"a": 1}, build)
    again = build_or_read(spark, root, "x", {"a": 1}, build)
    assert first.built and not again.built and again.rows.count() == 1 and len(calls) == 1
    changed = build_or_read(spark, root, "x", {"a": 2}, build)
    assert changed.built and changed.path != first.path and changed.rows.count() == 2
    after = build_or_read(spark, root, "y", {}, build, (first.version,))
    assert after.version != build_or_read(spark, root, "y", {}, build, (changed.version,)).version
    # A folder without its marker is a broken attempt.
    import os
    os.remove(f"{first.path}/data/_SUCCESS")
    redone = build_or_read(spark, root, "x", {"a": 1}, build)
    assert redone.built and redone.rows.count() == len(calls)
    forced = build_or_read(spark, root, "x", {"a": 1}, build, force_rebuild=True)
    assert forced.built and forced.rows.count() == len(calls)


def test_chain_builds_once_and_restores_the_text(spark, tmp_path):
    docs = table(spark, "/root/testdata/sf0.001", "documents", "doc_id", "source", "text").where(F.col("doc_id") < 60)
    articles = articles_from_documents(docs)

    def run(**kw):
        return prepare_pretraining(articles, str(tmp_path), "sf0.001", shares=SHARES, vocab_size=600, max_length=None, **kw)

    p = run()
    assert all(x.built for x in (p.sentences, p.vocab, p.encoded, p.masked))
    again = run()
    assert not any(x.built for x in (again.sentences, again.vocab, again.encoded, again.masked))
    more = run(probability=0.5)
    assert not more.encoded.built and more.masked.built
    splits = {r.split: r["count"] for r in p.sentences.rows.groupBy("split").count().collect()}
    assert set(splits) == set(SHARES)
    assert p.vocab.rows.count() <= 600 and p.vocab.rows.where("kind = 'merge'").count() > 100
    rows = p.masked.rows.select(F.explode(F.arrays_zip("input_ids", "masked_ids", "mlm_labels")).alias("z")).select("z.*")
    assert rows.where("mlm_labels != -100 AND mlm_labels != input_ids").count() == 0
    assert rows.where("mlm_labels = -100 AND masked_ids != input_ids").count() == 0
    from corpusmill.operators.vocab import words
    text = {(r.split, r.article_id, r.sent_idx): r.w for r in p.sentences.rows.where("split = 'train'").select(
        "split", "article_id", "sent_idx", F.array_join(words("text"), " ").alias("w")).collect()}
    got = {(r.split, r.article_id, r.sent_idx): r.text for r in restored_text(p).where("split = 'train'").collect()}
    assert got == text
