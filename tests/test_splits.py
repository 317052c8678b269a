"""Budgeted split rows of FIXTURES.md 4.3 plus split invariants."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import sampling as R

CASES = [
    ([4, 0, 5, 3, 0, 2], {"A": 5, "B": 3, "C": 9}, {"A": [1, 2, 3], "B": [4, 5, 6], "C": []}),
    ([6, 0, 1], {"A": 5, "B": 1}, {"A": [1], "B": [2, 3]}),
    ([3, 0], {"A": 5, "B": 5}, {"A": [1, 2], "B": []}),
]


@pytest.mark.parametrize("sizes,budgets,want", CASES)
def test_budget_split_golden(spark, sizes, budgets, want):
    df = spark.createDataFrame([(i + 1, s) for i, s in enumerate(sizes)],
                               "article_id long, size_bytes long")
    mib = {k: v / R.MIB for k, v in budgets.items()}
    assigned, _ = R.budget_split(df, mib, seed=None)
    got = {k: [] for k in budgets}
    for r in assigned.orderBy("seq").collect():
        got[r.split].append(r.article_id)
    assert got == want


def test_positions_do_not_depend_on_partitions(spark):
    from corpusmill.operators.positions import range_positions
    rows = [(i % 97 if i % 5 else None, i, None if i % 11 == 0 else i % 7) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, id long, size long")
    want, cum = [], 0
    for seq, (k, i, size) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))):
        want.append((i, seq, cum, cum + (size or 0)))
        cum += size or 0
    for n in (1, 3, 40):
        got = range_positions(df.repartition(5), ["k", "id"], "size", partitions=n)
        assert sorted(map(tuple, got.select("id", "seq", "before", "cum").collect())) == sorted(want)
    plan = range_positions(df, ["k", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert range_positions(df.limit(0), ["k"], "size").collect() == []


def test_shares_cover_the_table(spark):
    from corpusmill.plans.build_splits import build_splits
    from corpusmill.operators.sentences import articles_from_documents, sentences
    from corpusmill.sources.tables import table
    from conftest import SF001
    arts = articles_from_documents(table(spark, SF001, "documents", "doc_id", "source", "text"))
    b = build_splits(arts, shares={"train": 0.5, "val": 0.2, "test": 1.0})
    assert b.manifest.count() == arts.count()
    assert b.sentences.count() == sentences(arts, 5, 200).count()
    stats = {r.split: r.size_bytes for r in b.stats.collect()}
    assert stats["train"] > stats["test"] > 0 and stats["val"] > 0


def test_layout_prunes_folders_and_gives_the_same_splits(spark, tmp_path):
    from corpusmill.plans import build_splits as B
    from corpusmill.operators.sentences import articles_from_documents
    from corpusmill.sources.tables import table
    from conftest import SF01
    arts = articles_from_documents(table(spark, SF01, "documents", "doc_id", "source", "text"))
    budgets = {"train": 0.1, "val": 0.02, "test": 0.02}
    laid = B.write_layout(arts, str(tmp_path / "layout"), seed=3)
    plain, pruned = (B.build_splits(x, budgets, seed=3) for x in (arts, laid))
    assert plain.bounds == pruned.bounds
    cols = ["split", "article_id", "sent_idx", "text"]
    assert sorted(map(tuple, plain.sentences.select(cols).collect())) == sorted(map(tuple, pruned.sentences.select(cols).collect()))
    scan = laid.where(F.col(B.LAYOUT).between(0, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_bucket" in scan
    with pytest.raises(ValueError):
        B.build_splits(laid, budgets, seed=4)


def test_cap_is_one_group_limit(spark):
    df = spark.createDataFrame([(s, i) for s in ("train", "val", "test") for i in range(50)], "split string, i int")
    capped = R.cap_first_n(df, 7, ["i"])
    assert sorted((r.split, r["count"]) for r in capped.groupBy("split").count().collect()) == [("test", 7), ("train", 50), ("val", 7)]
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()


def test_splits_disjoint_and_budget_bound(spark):
    from corpusmill.plans.build_splits import build_splits
    from corpusmill.operators.sentences import articles_from_documents
    from corpusmill.sources.tables import table
    from conftest import SF01
    arts = articles_from_documents(table(spark, SF01, "documents", "doc_id", "source", "text"))
    b = build_splits(arts, {"train": 0.5, "val": 0.05, "test": 0.05})
    assert R.ids_in_all_splits(b.sentences.select("article_id", "split"), n_splits=2).count() == 0
    stats = {r.split: r for r in b.stats.collect()}
    man = b.manifest.join(
        b.sentences.groupBy(F.col("article_id").alias("id")).agg(F.sum(F.length("text")).alias("sz")),
        "id", "left").fillna(0)
    for split, budget in {"train": 0.5, "val": 0.05, "test": 0.05}.items():
        last = man.where(F.col("split") == split).orderBy(F.col("seq").desc()).first()
        size = stats[split].size_bytes
        assert size > budget * R.MIB
        assert size - last.sz <= budget * R.MIB


def test_early_stop_equals_full_walk(spark):
    from corpusmill.plans.build_splits import build_splits
    from corpusmill.operators.sentences import articles_from_documents
    from corpusmill.sources.tables import table
    from conftest import SF01
    arts = articles_from_documents(table(spark, SF01, "documents", "doc_id", "source", "text"))
    budgets = {"train": 0.2, "val": 0.05, "test": 0.05}
    fast = build_splits(arts, budgets, early_stop=True, first_fraction=1 / 64)
    full = build_splits(arts, budgets, early_stop=False)
    assert fast.bounds == full.bounds
    cols = ["split", "article_id", "sent_idx", "text"]
    assert sorted(map(tuple, fast.sentences.select(cols).collect())) == \
        sorted(map(tuple, full.sentences.select(cols).collect()))
    assert sorted(map(tuple, fast.manifest.collect())) == sorted(map(tuple, full.manifest.collect()))
