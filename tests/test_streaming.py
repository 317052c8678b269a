"""The stateless text operators give the same rows on a stream as in batch."""

from conftest import SF001


def test_stream_equals_batch(spark, tmp_path):
    from corpusmill.sources.tables import table
    from corpusmill.streaming import text_stream as TS
    src = str(tmp_path / "in")
    table(spark, SF001, "documents").repartition(3).write.parquet(src)
    q = TS.start(TS.read_documents_stream(spark, src, max_files_per_trigger=1),
                 str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, TS.anonymized_sentences(spark.read.parquet(src)).collect()))
    assert got == want and len(got) > 0
