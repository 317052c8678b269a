"""Token rows of FIXTURES.md 4.5-4.6 and vocabulary training vs brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import align as AL
from corpusmill.operators import encode as E
from corpusmill.operators import metrics as MT
from corpusmill.operators import pad as PD
from corpusmill.operators import vocab as V


@pytest.fixture(scope="module")
def small_vocab(spark):
    toks = list(V.SPECIALS) + ["Ann", "visit", "##ed", "Rey", "##kja", "##vik"]
    chars = sorted(set("AnvisitedReykjavik"))
    toks += chars + ["##" + c for c in chars]
    return spark.createDataFrame([(t, i) for i, t in enumerate(toks)], "token string, id int")


def _id(vocab, t):
    return vocab.where(F.col("token") == t).first().id


def test_align_golden(spark, small_vocab):
    df = spark.createDataFrame([(1, ["Ann", "visited", "Reykjavik"], [1, 0, 5])],
                               "id int, tokens array<string>, ner_tags array<int>")
    r = AL.align_labels(df, ["id"], small_vocab, max_length=10).first()
    want = ["[CLS]", "Ann", "visit", "##ed", "Rey", "##kja", "##vik", "[SEP]", "[PAD]", "[PAD]"]
    assert r.input_ids == [_id(small_vocab, t) for t in want]
    assert r.word_ids == [None, 0, 1, 1, 2, 2, 2, None, None, None]
    assert r.labels == [-100, 1, 0, -100, 5, -100, -100, -100, -100, -100]
    assert r.attention_mask == [1] * 8 + [0, 0]
    assert r.text == "Ann visited Reykjavik"
    r6 = AL.align_labels(df, ["id"], small_vocab, max_length=6).first()
    assert r6.input_ids == [_id(small_vocab, t) for t in want[:6]]
    assert r6.word_ids == [None, 0, 1, 1, 2, 2]
    # entity read-out with predicted classes 0 1 0 0 5 5 5 0 0 0
    pred = spark.createDataFrame([(1, [0, 1, 0, 0, 5, 5, 5, 0, 0, 0])], "id int, pred array<int>")
    aligned = AL.align_labels(df, ["id"], small_vocab, max_length=10).join(pred, "id")
    ents = MT.entities(aligned, ["id"]).orderBy("first_pos").collect()
    assert [(e.word, e.tags) for e in ents] == [("Ann", [1]), ("Reykjavik", [5, 5, 5])]


def _vocab_of(spark, *tokens):
    rows = [(t, i) for i, t in enumerate([*V.SPECIALS, *tokens])]
    return spark.createDataFrame(rows, "token string, id int")


def test_unknown_and_long_words(spark):
    vocab = _vocab_of(spark, "Ann", "a", "##a", "##aaaa")
    df = spark.createDataFrame([(1, "Ann zzz " + "a" * 501)], "id int, text string")
    r = E.encode(df, ["id"], vocab, max_length=None).first()
    n = len(V.SPECIALS)
    assert r.input_ids == [V.CLS_ID, n, V.UNK_ID, n + 1] + [n + 3] * 125 + [V.SEP_ID]


def test_repeated_ids_and_null_tokens_keep_rows_and_slots(spark):
    vocab = _vocab_of(spark, "ab", "ef", "x")
    df = spark.createDataFrame([(1, "ab x", 7), (1, "ef", 8), (1, "ef", 8), (2, "", 9), (3, None, 9)], "id int, text string, label int")
    n = len(V.SPECIALS)
    got = sorted((r.id, r.label, r.input_ids) for r in E.encode(df, ["id", "label"], vocab).collect())
    assert got == [(1, 7, [V.CLS_ID, n, n + 2, V.SEP_ID]), (1, 8, [V.CLS_ID, n + 1, V.SEP_ID]), (1, 8, [V.CLS_ID, n + 1, V.SEP_ID]),
                   (2, 9, [V.CLS_ID, V.SEP_ID]), (3, 9, [V.CLS_ID, V.SEP_ID])]
    tok = spark.createDataFrame([(1, ["ab", None, "ef"], [4, 5, 6]), (1, ["x"], [3])], "id int, tokens array<string>, ner_tags array<int>")
    a = sorted((r.words, r.word_ids, r.labels) for r in AL.align_labels(tok, ["id"], vocab, max_length=5).collect())
    assert a[0] == (["ab", None, "ef"], [None, 0, 2, None, None], [-100, 4, 6, -100, -100])
    assert a[1] == (["x"], [None, 0, None, None, None], [-100, 3, -100, -100, -100])
    pairs = spark.createDataFrame([(1, "ab", "ef x", 0), (1, "x", None, 1)], "id int, sentence1 string, sentence2 string, label int")
    p = sorted((r.label, r.input_ids, r.token_type_ids) for r in E.encode_pairs(pairs, ["id", "label"], vocab).collect())
    assert p == [(0, [V.CLS_ID, n, V.SEP_ID, n + 1, n + 2, V.SEP_ID], [0, 0, 0, 1, 1, 1]),
                 (1, [V.CLS_ID, n + 2, V.SEP_ID, V.SEP_ID], [0, 0, 0, 1])]
    ids = spark.createDataFrame([(1, [n, 99]), (1, []), (1, None)], "id int, ids array<int>")
    assert sorted(r.tokens for r in E.ids_to_tokens(ids, ["id"], "ids", vocab).collect()) == [[], [], ["ab", "[UNK]"]]


def test_vocabulary_never_exceeds_its_size(spark):
    df = spark.createDataFrame([("abab abab cd",), ("ab cd ef",)], "text string")
    for size in (6, 8, 14):
        assert V.train_vocab(df, vocab_size=size).count() <= size
    # All first candidates blocked: the search widens instead of stopping.
    assert V.choose_merges([("a", "##b", 3)], 5, {"ab"}) == []


def test_pad_batches(spark):
    df = spark.createDataFrame([(i, [7] * n) for i, n in enumerate([3, 5, 2, 4])],
                               "id long, input_ids array<int>")
    b = PD.batch_ids(df, ["id"], 3)
    got = {r.id: r.padded_len for r in PD.pad_batches(b).collect()}
    assert [got[i] for i in range(4)] == [5, 5, 5, 4]


def test_metrics_golden(spark):
    df = spark.createDataFrame([(-100, 3), (1, 1), (0, 2), (-100, 0)], "label int, pred int")
    assert MT.masked_accuracy(df, "pred", "label").first().accuracy == 0.5
    b = spark.createDataFrame(list(zip([1, 1, 0, 0, 1], [1, 0, 0, 1, 1])), "p int, r int")
    m = MT.binary_metrics(b, "p", "r").first()
    assert m.accuracy == 0.6 and m.f1 == 0.666667
    s = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    assert s.select(MT.argmax("s").alias("a")).first().a == 1


def test_truncate_pair_longest_first(spark):
    def brute(la, lb, budget):
        while la + lb > budget:
            if la > lb:
                la -= 1
            else:
                lb -= 1
        return la, lb
    cases = [(la, lb) for la in range(0, 12) for lb in range(0, 12)]
    df = spark.createDataFrame(cases, "la int, lb int")
    na, nb = E.truncate_pair(F.col("la"), F.col("lb"), 9)
    for r in df.select("la", "lb", na.alias("na"), nb.alias("nb")).collect():
        assert (r.na, r.nb) == brute(r.la, r.lb, 9), r


def _brute_bpe(words: Counter, vocab_size: int, min_count: int = 2):
    seqs = {w: [w[0]] + ["##" + c for c in w[1:]] for w in words}
    alphabet = sorted({s for q in seqs.values() for s in q})
    vocab = list(V.SPECIALS) + [a for a in alphabet if not a.startswith("##")] + \
        [a for a in alphabet if a.startswith("##")]
    taken = set(vocab)
    while len(vocab) < vocab_size:
        pc = Counter()
        for w, q in seqs.items():
            for a, b in zip(q, q[1:]):
                pc[(a, b)] += words[w]
        cands = sorted(((-n, a, b) for (a, b), n in pc.items() if n >= min_count))
        pick = next(((a, b) for _, a, b in cands if V.merged_token(a, b) not in taken), None)
        if pick is None:
            break
        tok = V.merged_token(*pick)
        vocab.append(tok)
        taken.add(tok)
        for w, q in seqs.items():
            out, i = [], 0
            while i < len(q):
                if i + 1 < len(q) and (q[i], q[i + 1]) == pick:
                    out.append(tok)
                    i += 2
                else:
                    out.append(q[i])
                    i += 1
            seqs[w] = out
    return vocab


def test_train_vocab_exact_mode_matches_brute_force(spark):
    from conftest import SF001
    from corpusmill.operators.sentences import articles_from_documents, sentences
    from corpusmill.sources.tables import table
    docs = table(spark, SF001, "documents", "doc_id", "source", "text").where(F.col("doc_id") < 5)
    sents = sentences(articles_from_documents(docs), 5, 200)
    wc = Counter({r.word: r.n for r in V.word_counts(sents).collect()})
    n_alpha = len({c for w in wc for c in [w[0]] + ["##" + x for x in w[1:]]})
    size = len(V.SPECIALS) + n_alpha + 25
    got = [r.token for r in V.train_vocab(sents, vocab_size=size, merges_per_round=1, growth=0.0)
           .orderBy("id").collect()]
    assert got == _brute_bpe(wc, size)


def test_batched_merges_equal_sequential_application(spark):
    rows = [(["a", "##b", "##c", "##b", "##c"], 3), (["w", "##x", "##y"], 2), (["a", "##a", "##a"], 4)]
    df = spark.createDataFrame(rows, "syms array<string>, n long")
    cands = [("##b", "##c", 9), ("a", "##b", 8), ("##x", "##y", 7), ("w", "##x", 6), ("a", "##a", 5)]
    chosen = V.choose_merges(cands, 10, set())
    # ("w", "##x") ends on the left symbol of the higher-ranked ("##x", "##y"): deferred
    assert ("w", "##x", 6) not in chosen
    merges = {(a, b): V.merged_token(a, b) for a, b, _ in chosen}
    got = [r.s for r in df.select(V.apply_merges(F.col("syms"), merges).alias("s")).collect()]

    def seq(q):
        for a, b, _ in chosen:
            out, i = [], 0
            while i < len(q):
                if i + 1 < len(q) and (q[i], q[i + 1]) == (a, b):
                    out.append(V.merged_token(a, b))
                    i += 2
                else:
                    out.append(q[i])
                    i += 1
            q = out
        return q
    assert got == [seq(q) for q, _ in rows]


def test_length_checks(spark, small_vocab):
    df = spark.createDataFrame([(1, ["Ann", "visited"], [1, 0])],
                               "id int, tokens array<string>, ner_tags array<int>")
    r = AL.align_labels(df, ["id"], small_vocab, max_length=8, check_lengths=True).first()
    assert len(r.input_ids) == len(r.labels) == len(r.word_ids) == 8


def _word_counts(spark, sf_dir):
    from corpusmill.operators.sentences import articles_from_documents, sentences
    from corpusmill.sources.tables import table
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return sentences(articles_from_documents(docs), 5, 200)


def _indexed_bpe(words: Counter, vocab_size: int, min_count: int = 2):
    """One merge at a time, as ``_brute_bpe``, with an index of the words of a pair."""
    import heapq
    seqs = {w: [w[0]] + ["##" + c for c in w[1:]] for w in words}
    alphabet = {s for q in seqs.values() for s in q}
    out, size, taken = [], len(V.SPECIALS) + len(alphabet), set(alphabet) | set(V.SPECIALS)
    count, where = Counter(), {}
    for w, q in seqs.items():
        for p in zip(q, q[1:]):
            count[p] += words[w]
            where.setdefault(p, set()).add(w)
    heap = [(-n, *p) for p, n in count.items()]
    heapq.heapify(heap)
    while heap and size < vocab_size:
        n, a, b = heapq.heappop(heap)
        if count[a, b] != -n or -n < min_count or V.merged_token(a, b) in taken:
            continue
        tok = V.merged_token(a, b)
        out.append(tok)
        taken.add(tok)
        size += 1
        for w in list(where[a, b]):
            q, new, i = seqs[w], [], 0
            while i < len(q):
                hit = i + 1 < len(q) and (q[i], q[i + 1]) == (a, b)
                new.append(tok if hit else q[i])
                i += 1 + hit
            seqs[w] = new
            for sign, s in ((-1, q), (1, new)):
                for p in zip(s, s[1:]):
                    count[p] += sign * words[w]
                    where.setdefault(p, set()).add(w)
                    heapq.heappush(heap, (-count[p], *p))
    return out


def test_twenty_thousand_tokens_equal_sequential_training(spark):
    sents = _word_counts(spark, "/root/testdata/sf0.01")
    wc = Counter({r.word: r.n for r in V.word_counts(sents).collect()})
    rows = V.train_vocab(sents, vocab_size=20000).orderBy("id").collect()
    assert len(rows) == 20000
    assert [r.token for r in rows if r.kind == "merge"] == _indexed_bpe(wc, 20000)


def test_small_working_sets_give_the_same_merges(spark):
    """Rounds that may hold almost no words: merges chosen on the cluster, exact."""
    from corpusmill.operators.bpe import sequential_merges
    from corpusmill.operators.sentences import articles_from_documents, sentences
    from corpusmill.sources.tables import table
    from conftest import SF001
    docs = table(spark, SF001, "documents", "doc_id", "source", "text").where(F.col("doc_id") < 5)
    sents = sentences(articles_from_documents(docs), 5, 200)
    wc = V.word_counts(sents)
    words = wc.select(V.initial_symbols("word").alias("syms"), "n")
    counts = Counter({r.word: r.n for r in wc.collect()})
    alphabet = {c for w in counts for c in [w[0]] + ["##" + x for x in w[1:]]}
    want = _brute_bpe(counts, len(V.SPECIALS) + len(alphabet) + 16)[len(V.SPECIALS) + len(alphabet):]
    for working, look in ((0, 64), (2000, 16)):
        got = sequential_merges(words, 16, set(alphabet) | set(V.SPECIALS), working_symbols=working, look=look)
        assert [V.merged_token(a, b) for a, b in got] == want


def test_repeated_symbols_and_blocked_pairs(spark):
    from corpusmill.operators.bpe import sequential_merges
    words = Counter({"aaaa": 3, "aaaaa": 2, "banana": 4, "bandana": 2, "abab": 5, "a": 9, "nana": 1})
    df = spark.createDataFrame([([w[0]] + ["##" + c for c in w[1:]], n) for w, n in words.items()], "syms array<string>, n long")
    alphabet = {c for w in words for c in [w[0]] + ["##" + x for x in w[1:]]}
    base = len(V.SPECIALS) + len(alphabet)
    want = _brute_bpe(words, base + 12)[base:]
    for working in (0, 1 << 19):
        got = sequential_merges(df, 12, set(alphabet) | set(V.SPECIALS), working_symbols=working)
        assert [V.merged_token(a, b) for a, b in got] == want


def test_trie_equals_join_lookup(spark, monkeypatch):
    sents = _word_counts(spark, "/root/testdata/sf0.001").limit(400).cache()
    vocab = V.fixed_vocab(sents, "text", 300).cache()
    key = ["article_id", "sent_idx"]
    trie = sorted((r.article_id, r.sent_idx, r.input_ids) for r in E.encode(sents, key, vocab).collect())
    names = sorted((r.article_id, r.text) for r in E.decode(E.encode(sents, key, vocab), key, "input_ids", vocab).collect())
    plan = E.encode(sents, key, vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryTableScan")[0]
    monkeypatch.setattr(E, "BROADCAST_BYTES", 0)
    joined = sorted((r.article_id, r.sent_idx, r.input_ids) for r in E.encode(sents, key, vocab).collect())
    assert trie == joined
    assert names == sorted((r.article_id, r.text) for r in E.decode(E.encode(sents, key, vocab), key, "input_ids", vocab).collect())


def test_mask_view_with_predictions(spark):
    from corpusmill.operators import mask as M
    vocab = _vocab_of(spark, "ab", "##cd", "x")
    n = len(V.SPECIALS)
    df = spark.createDataFrame([(1, [2, n, n + 1, n + 2, 3], [2, n, V.MASK_ID, n + 2, 3], [2, n, n + 1, n, 3])],
                               "id int, input_ids array<int>, masked_ids array<int>, guess array<int>")
    r = M.mask_view(df, ["id"], vocab, predicted_col="guess").first()
    assert (r.original, r.masked, r.predicted) == ("abcd x", "ab [MASK] x", "abcd ab")


def test_next_token_guesses(spark):
    from corpusmill.operators import predict as PR
    n = len(V.SPECIALS)
    df = spark.createDataFrame([([2, n, n + 1, n, n + 1, 3],), ([2, n, n + 2, 3],), ([2, n + 2, 3],), ([2, 3],), ([],)], "input_ids array<int>")
    table = {r.prev: r.guess for r in PR.next_token_table(df).collect()}
    assert table == {2: n, n: n + 1, n + 1: n, None: n}
    m = spark.createDataFrame([([2, V.MASK_ID, V.MASK_ID, 3], [-100, n, n + 1, -100]), ([2, n, V.MASK_ID, 3], [-100, -100, n + 1, -100])],
                              "masked_ids array<int>, mlm_labels array<int>")
    got = [r.predicted_ids for r in PR.predict_masked(m, PR.next_token_table(df), n + 3).collect()]
    assert got == [[2, n, n, 3], [2, n, n + 1, 3]]


# ----------------------------------------------------------------- arrays instead of rows
def test_entities_make_rows_of_classed_positions_only(spark):
    from corpusmill.operators.metrics import entities
    df = spark.createDataFrame([(1, ["a", "b", "a", "c"], [None, 0, 1, 1, 2, 9, None, None], [7, 5, 0, 6, 5, 4, 3, 0],
                                 [1, 1, 1, 1, 1, 1, 1, 0])],
                               "id bigint, words array<string>, word_ids array<int>, pred array<int>, attention_mask array<int>")
    e = entities(df, ["id"])
    # valid positions 1 to 5: pieces of words 0, 1, 1, 2 and a word id beyond the words
    assert sorted(map(tuple, e.collect())) == [(1, "[INV]", 4, [4]), (1, "a", 0, [5, 5]), (1, "b", 2, [6])]
    plan = e._jdf.queryExecution().executedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "words" not in generate.split("), [")[-1]       # the row's words are not copied to each position


def test_aligned_rows_equal_those_of_the_join(spark, monkeypatch):
    from corpusmill.operators import align as AL
    from corpusmill.operators import encode as E
    rows = [(1, ["ab", "c", None, "abc", "x"], [1, 2, 3, 0, 4]), (2, [], []), (3, None, None), (4, ["c"] * 9, [5] * 4),
            (5, ["ab"], [None])]
    df = spark.createDataFrame(rows, "id bigint, tokens array<string>, ner_tags array<int>")
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate([*E.SPECIALS, "a", "b", "c", "##b", "##c"])], "token string, id int")
    for length, special in ((6, True), (1, True), (4, False), (None, True), (None, False)):
        def run():
            return sorted((r.asDict() for r in AL.align_labels(df, ["id"], vocab, max_length=length, add_special_tokens=special).collect()),
                          key=lambda r: r["id"])
        got = run()
        with monkeypatch.context() as m:
            m.setattr(E, "BROADCAST_BYTES", 0)
            assert got == run(), (length, special)


def test_ascii_words_are_those_of_the_pattern(spark):
    from pyspark.sql import functions as F
    from corpusmill.operators import encode as E
    from corpusmill.operators import vocab as V
    texts = ["", None, " ", "a", "ab cd", "a.b", "..", "x\u00e9 \u2014y\u3002 z", "tab\tnew\nline\x1cz\x85", "a", "b ", " \x7f!c",
             "".join(map(chr, range(128))), "".join(map(chr, range(100, 400)))]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").coalesce(1)
    alphabet = sorted({c for t in texts if t for c in t if not c.isspace() or c == "\x85"})
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate([*E.SPECIALS, *alphabet, *["##" + c for c in alphabet]])],
                                  "token string, id int")
    want = E.word_pieces(df, ["id"], V.words("text"), vocab).select("id", F.flatten("pieces").alias("p")).collect()
    got = E.encode(df, ["id"], vocab, max_length=None, add_special_tokens=False).select("id", F.col("input_ids").alias("p")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    texts_of = E.decode(E.word_pieces(df, ["id"], V.words("text"), vocab).select("id", F.flatten("pieces").alias("p")), ["id"], "p", vocab)
    named = E.ids_to_tokens(E.word_pieces(df, ["id"], V.words("text"), vocab).select("id", F.flatten("pieces").alias("p")), ["id"], "p", vocab)
    assert sorted(map(tuple, texts_of.collect())) == sorted(map(tuple, named.select("id", E.tokens_to_text("tokens")).collect()))


def test_words_of_ascii_and_other_texts_are_counted(spark):
    from collections import Counter
    import re
    from corpusmill.operators import vocab as V
    texts = ["a b a, a", None, "", "été a —", "b"] * 4
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    wc = V.word_counts(df)
    want = Counter(w for t in texts if t for w in re.findall(r"[,—]|[^ ,—]+", t))
    assert dict(map(tuple, wc.collect())) == want
    from pyspark.sql import functions as F
    from corpusmill.functions import patterns as P
    every = spark.createDataFrame([("".join(chr(i) + chr(j) for j in range(128)),) for i in range(128)], "t string")
    assert all(r.a == r.b for r in every.select(F.regexp_extract_all("t", F.lit(P.WORD), 0).alias("a"),
                                                F.regexp_extract_all("t", F.lit(P.ASCII_WORD), 0).alias("b")).collect())


def test_neighbours_are_counted_per_batch(spark):
    from corpusmill.operators import predict as PR
    df = spark.createDataFrame([([2, 7, 8, 7, 8, 7, 9, 3],), ([],), (None,), ([2],), ([2, 9, 3],), ([2, 7],)], "input_ids array<int>")
    t = PR.next_token_table(df)
    assert dict(map(tuple, t.collect())) == {2: 7, 7: 8, 8: 7, None: 7}
    assert "Generate" not in t._jdf.queryExecution().executedPlan().toString()


def test_masking_makes_no_expression_per_position(spark):
    import hashlib
    from pyspark.sql import functions as F
    from corpusmill.operators import mask as M
    df = spark.createDataFrame([(i, [2] + [5 + (i * j) % 20 for j in range(40)] + [3]) for i in range(30)] + [(99, None)],
                               "id bigint, input_ids array<int>")
    m = M.mlm_mask(df, F.col("id").cast("string"), vocab_size=25, probability=0.4, seed=3)
    for r in m.collect():
        if r.input_ids is None:
            assert r.masked_ids is None and r.mlm_labels is None
            continue
        for j, x in enumerate(r.input_ids):
            u = [int(hashlib.md5(f"3:{r.id}:{j}".encode()).hexdigest()[8 * n:8 * n + 8], 16) for n in range(3)]
            hit = x >= 5 and u[0] < 0.4 * 2 ** 32
            new = 4 if u[1] < 0.8 * 2 ** 32 else u[2] % 20 + 5 if u[1] < 0.9 * 2 ** 32 else x
            assert (r.masked_ids[j], r.mlm_labels[j]) == ((new, x) if hit else (x, -100))
    assert "lambda" not in m._jdf.queryExecution().executedPlan().toString()


def test_id_lists_as_text(spark):
    from corpusmill.plans.queries_tokens import _ints
    df = spark.createDataFrame([(0, [1, None, -100]), (1, []), (2, None), (3, [7])], "k int, v array<int>")
    c = _ints("v")
    assert [r.t for r in df.orderBy("k").select(c.alias("t")).collect()] == ["1 null -100", "", None, "7"]
    assert "transform" not in df.select(c)._jdf.queryExecution().executedPlan().toString()


def test_words_come_to_the_driver_as_distinct_stretches(spark):
    from corpusmill.operators import bpe
    assert bpe.stretches(list("xabyz"), {("a", "b")}) == [list("xaby")]
    assert bpe.stretches(list("abxcd"), {("a", "b"), ("c", "d")}) == [list("abx"), list("xcd")]
    assert bpe.stretches(list("zabcdz"), {("a", "b"), ("c", "d")}) == [list("zabcdz")]      # one: both sides may change
    assert bpe.stretches(["a"], {("a", "b")}) == bpe.stretches(list("ba"), {("a", "b")}) == []
    # 900 words share one stretch: 4 symbols at the driver, not 900 words
    words = spark.createDataFrame([([str(i), "p", "a", "b", "q", str(i)], 2) for i in range(900)], "syms array<string>, n bigint")
    assert [(r.syms, r.n) for r in bpe._cut(words, {("a", "b")}).collect()] == [(list("pabq"), 1800)]


def test_merges_from_stretches_equal_one_at_a_time(spark):
    import random
    from corpusmill.operators import bpe
    rng = random.Random(5)
    rows = {tuple(rng.choice("aabbcd") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 30) for _ in range(300)}
    state, want, taken = [(list(w), n) for w, n in rows.items()], [], set("abcd")
    while len(want) < 60:
        count = {}
        for w, n in state:
            for p in zip(w, w[1:]):
                count[p] = count.get(p, 0) + n
        left = sorted((-n, *p) for p, n in count.items() if n >= 2 and bpe.merged_token(*p) not in taken)
        if not left:
            break
        p = left[0][1:]
        want.append(p)
        taken.add(bpe.merged_token(*p))
        state = [(bpe._replace(w, p, bpe.merged_token(*p)), n) for w, n in state]
    words = spark.createDataFrame([(list(w), n) for w, n in rows.items()], "syms array<string>, n bigint")
    for working, look in ((1 << 19, 16384), (400, 6)):
        assert bpe.sequential_merges(words, 60, set("abcd"), working_symbols=working, look=look) == want


def _one_at_a_time(rows: dict, room: int, taken: set) -> list:
    from corpusmill.operators import bpe
    state, out = [(list(w), n) for w, n in rows.items()], []
    while len(out) < room:
        count = {}
        for w, n in state:
            for p in zip(w, w[1:]):
                count[p] = count.get(p, 0) + n
        left = sorted((-n, *p) for p, n in count.items() if n >= 2 and bpe.merged_token(*p) not in taken)
        if not left:
            break
        p = left[0][1:]
        out.append(p)
        taken.add(bpe.merged_token(*p))
        state = [(bpe._replace(w, p, bpe.merged_token(*p)), n) for w, n in state]
    return out


def test_a_round_takes_all_merges_above_its_floor(spark, monkeypatch):
    """The words are rewritten a few times, not once for each handful of merges, whether they fit the driver or not."""
    import random
    from corpusmill.operators import bpe
    rng = random.Random(9)
    rows = {tuple(rng.choice("aaabbcdefgh") for _ in range(rng.randrange(2, 14))): int(rng.paretovariate(0.8)) for _ in range(1500)}
    want = _one_at_a_time(rows, 200, set("abcdefgh"))
    words = spark.createDataFrame([(list(w), n) for w, n in rows.items()], "syms array<string>, n bigint")
    labels, stage = [], bpe.stage
    monkeypatch.setattr(bpe, "stage", lambda df, label: labels.append(label) or stage(df, label))
    assert bpe.sequential_merges(words, 200, set("abcdefgh")) == want
    assert labels == ["words"]                          # all of them fit: no other round
    labels.clear()
    assert bpe.sequential_merges(words, 200, set("abcdefgh"), working_symbols=4000) == want
    assert 2 <= labels.count("words") <= 6 and "stretches" not in labels


def test_words_are_cut_where_pairs_are_rare(spark):
    import numpy as np
    from corpusmill.operators import bpe
    wc = spark.createDataFrame([(f"{chr(200 + i)}pabq{chr(200 + i)}", 2) for i in range(900)] + [("ab", 5)], "word string, n bigint")
    pair = (ord("a") + bpe.INNER << 32) + ord("b") + bpe.INNER
    got = bpe.cut_words(bpe.coded_words(wc), np.array([pair])).collect()
    assert [([bpe.coded_name(x) for x in np.frombuffer(r.syms, np.int32).tolist()], r.n) for r in got] == [(["##a", "##b"], 1800)]


def test_merges_of_a_batch_equal_one_word_at_a_time():
    import random
    import numpy as np
    from corpusmill.operators import bpe
    rng = random.Random(2)
    words = [[rng.choice((1, 1, 1, 2, 3)) for _ in range(n)] for n in (1, 2, 3, 700, 9, 256, 257, 1, 30, 5) * 4]
    merges = [(1, 1), (2, 1), (10, 10), (3, 11), (12, 1), (10, 1), (12, 12), (1, 2)]
    keys = np.array([a << 32 | b for a, b in merges])
    order = np.argsort(keys)
    codes, sizes = bpe.merge_words(np.array([x for w in words for x in w], np.int32), np.array([len(w) for w in words]),
                                   keys[order], order.astype(np.int32), 10)
    want = []
    for w in words:
        for i, p in enumerate(merges):
            w = bpe._replace(w, p, 10 + i)
        want.append(w)
    ends = np.cumsum(sizes).tolist()
    assert [codes[i:j].tolist() for i, j in zip([0, *ends], ends)] == want
    # One word of 200,000 characters does not cost the square of its length.
    import time
    began = time.time()
    codes, sizes = bpe.merge_words(np.tile(np.array([1, 2, 3, 1], np.int32), 50_000), np.array([200_000]), keys[order], order.astype(np.int32), 10)
    assert time.time() - began < 20 and sizes.tolist() == [len(codes)]


def test_words_counted_in_slices_and_parts(spark, monkeypatch):
    import pyarrow as pa
    from corpusmill.functions import words as W
    texts = ["a b, c a", None, "é b a", "", "x" * 50 + " a"] * 40 + [f"w{i}" for i in range(300)]
    want = Counter(w for t in texts if t for w in t.replace(",", " , ").split())
    got = V.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert {r.word: r.n for r in got.collect()} == want
    monkeypatch.setattr(W, "SLICE", 64)
    monkeypatch.setattr(W, "HELD", 50)
    ascii_only = [t if t is None or t.isascii() else None for t in texts]
    other = [None if t is None or t.isascii() else t.split() for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(ascii_only, pa.string()), pa.array(other, pa.list_(pa.string()))], ["text", "others"])
    total = Counter()
    parts = list(W.count_words([batch, batch.slice(3, 7), batch.slice(0, 0)]))
    for part in parts:
        for w, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            total[w] += n
    assert len(parts) > 1 and total == want + Counter(w for t in texts[3:10] if t for w in t.replace(",", " , ").split())


def test_digests_of_numbered_texts():
    import hashlib
    import numpy as np
    import pyarrow as pa
    from corpusmill.functions.digests import md5_of_numbered
    keys = ["0:1:2:", "", None, "é" * 9, *("x" * n for n in (48, 49, 50, 53, 54, 55, 56, 64, 200))]
    row, number = np.repeat(np.arange(len(keys)), 12), np.tile(np.array([0, 1, 9, 10, 99, 100, 127, 999, 1000, 12345, 7, 8]), len(keys))
    for column, numbers in ((pa.array(keys, pa.string()), number), (pa.array(["a", *keys], pa.string()).slice(1), number * 10 ** 9)):
        got = md5_of_numbered(column, row, numbers)
        want = [hashlib.md5(f"{keys[r] or ''}{n}".encode()).hexdigest() for r, n in zip(row.tolist(), numbers.tolist())]
        assert ["".join(f"{x:08x}" for x in r) for r in got.tolist()] == want
    assert md5_of_numbered(pa.array([], pa.string()), row[:0], number[:0]).shape == (0, 4)


def test_masking_takes_no_hash_object_per_position(monkeypatch):
    import hashlib
    import pyarrow as pa
    from corpusmill.operators import mask
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda *a: calls.append(a) or md5(*a))
    column = pa.array([list(range(5, 60)), None, [1, 2], [None, 7]], pa.list_(pa.int32()))
    keys = pa.array(["0:1:0:", "0:1:1:", "0:1:2:", "0:1:3:"])
    masked, labels = mask.mask_batch(keys, column, 100, 1.0, 5)
    assert not calls and labels.to_pylist() == [*range(5, 60), -100, -100, -100, 7] and masked[57].as_py() is None


def test_ascii_texts_have_no_null_list_beside_them(spark):
    """Arrow's writer goes over a run of NULL lists once for each of them."""
    from corpusmill.functions.words import other_words
    df = spark.createDataFrame([("ab c",), ("é b",), (None,)], "t string")
    assert [r.o for r in df.select(other_words(F.col("t")).alias("o")).collect()] == [[], ["é", "b"], []]


def test_pieces_of_a_batch_beyond_the_words_remembered(monkeypatch):
    import pyarrow as pa
    w = E.WordPieces(["[PAD]", "[UNK]", "ab", "##c", "é", "##é", "a"], [0, 1, 2, 3, 4, 5, 6])
    for limit in (1 << 18, 1):
        monkeypatch.setattr(E, "MEMO_WORDS", limit)
        for words in (["ab", None, "abc", "zz", "éé", "", "ab"], ["abcc", "a", "ab"], [], [None]):
            size, flat = w.pieces_of(pa.array(words, pa.string()))
            want = [() if x is None else w.pieces(x) for x in words]
            assert size.tolist() == [len(p) for p in want] and flat.tolist() == [i for p in want for i in p]


def test_short_tokens_by_text_equal_the_trie(monkeypatch):
    import random
    rng = random.Random(4)
    tokens = list(dict.fromkeys(["[PAD]", "[UNK]", "", "a", "##a", "b", "##", "##b", *(rng.choice(("", "##")) + "".join(
        rng.choice("abcé#") for _ in range(rng.randrange(1, 6))) for _ in range(60))]))
    short = E.WordPieces(tokens, list(range(len(tokens))))
    monkeypatch.setattr(E, "SHORT_TOKEN", 0)
    trie = E.WordPieces(tokens, list(range(len(tokens))))
    assert short._short and not trie._short
    for _ in range(3000):
        word = "".join(rng.choice("abcé#") for _ in range(rng.randrange(0, 12)))
        assert short.pieces(word) == trie.pieces(word), word


def test_predictions_encode_each_sentence_once(spark, monkeypatch):
    from conftest import SF001
    from corpusmill.plans import queries_tokens as Q
    labels = []
    monkeypatch.setattr(Q, "stage", lambda df, label, stage=Q.stage: labels.append(label) or stage(df, label))
    df = Q.q_mask_predict(spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert labels == ["sentences", "encoded", "masked"] and "ids_of" not in plan and "regexp_extract_all" not in plan
    assert df.count() > 0
