"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and fully materialized (``noop`` sink) in one session;
caches are cleared between queries.  Before timing, one small query runs on
sf0.001 so that JVM start-up and code generation are not charged to the
first timed query.  A query that takes less than ``REPEAT_BELOW`` seconds runs
three times and its median counts.  Prints ONE JSON line with seconds per
query, their sum as ``value``, and MiB/s of document text for the operators
that read all of it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["sentence_filter", "budget_split", "anonymize", "anonymize_dataset", "pii_by_type",
            "word_counts", "encode", "ner_align", "mlm_mask", "encode_pairs", "vocab",
            "pad_batch", "mask_view", "decode", "entities_from_tags", "anonymize_grouped"]
THROUGHPUT = {"sentence_filter", "anonymize", "encode"}
REPEAT_BELOW = 8.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from pyspark.sql import functions as F

    from corpusmill.plans import registry
    from corpusmill.session import checkpoint_dir, local_session
    from corpusmill.sources.tables import table

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    checkpoint_dir(spark)
    registry.load_all()
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        registry.QUERIES["sentence_filter"](spark, warm).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    text_mib = (table(spark, sf_dir, "documents", "text")
                .agg(F.sum(F.octet_length("text"))).first()[0] or 0) / 2 ** 20
    out, rates = {}, {}
    for n in names:
        times = []
        while not times or len(times) < 3 and times[0] < REPEAT_BELOW:
            t0 = time.time()
            registry.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - t0)
            spark.catalog.clearCache()
        out[n] = round(statistics.median(times), 3)
        if n in THROUGHPUT and out[n] > 0:
            rates[n] = round(text_mib / out[n], 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "mib_per_sec": rates, "text_mib": round(text_mib, 3),
                      "cpus": int(cpus), "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
