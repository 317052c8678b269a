"""Decontamination: copies, re-parameterised questions, awkward rows."""

from corpusmill.llm import decontam
from tests.llm import brute
from tests.llm.conftest import SCHEMA, make_rows

ITEMS = [(1, "A train leaves Paris at 9:30 and travels 120 km to Lyon at a speed of 60 km per hour without a stop."),
         (2, "what is the sum of 7 and 7 plus 12 if 7 counts twice"),
         (3, "short item here"), (4, None), (5, "  ")]


def _pairs(df):
    return sorted({(r.doc_id, r.item_id) for r in df.collect()})


def _run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = _pairs(decontam.contaminated(docs, items, **kw))
    # The shuffle join finds the same rows as the broadcast.
    both = [decontam.contaminated(docs, items, max_broadcast=n, **kw).collect() for n in (0, 10_000)]
    assert sorted(both[0]) == sorted(both[1])
    return got


def test_copies_and_reparameterised_questions(spark):
    rows = [(10, "Before. A train leaves Paris at 9:30 and travels 120 km to Lyon at a speed of 60 km per hour without a stop. After"),
            (11, "one train leaves Berlin at 7:15 and travels 333 miles to Munich at a speed of 45 miles per hour without a stop"),
            (12, "A TRAIN LEAVES PARIS AT 9:30 AND TRAVELS"), (13, "we say short item here and go on"),
            (14, "what is the sum of 8 and 8 plus 31 if 8 counts twice"),
            (15, "nothing of that kind is written here at all, 12 km from Lyon"), (16, None), (17, "")]
    assert _run(spark, rows) == [(10, 1), (11, 1), (13, 3), (14, 2)]


def test_inconsistent_slots_are_no_copy(spark):
    # 7 appears three times in the item; here the values differ from place to place.
    rows = [(20, "what is the sum of 8 and 9 plus 31 if 10 counts twice"), (21, "what is the sum of 5 and 5 plus 5 if 5 counts twice")]
    assert _run(spark, rows) == []


def test_awkward_rows_and_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(docs, items).collect() == []
    assert decontam.contaminated(no_docs, items).collect() == []
    assert decontam.contaminated(docs, none).collect() == []
    text = ITEMS[0][1]
    rows = [(r[0], (r[1] or "") + " " + text, *r[2:], 1, "x", 2, 3, "y") for r in make_rows()]
    got = decontam.contaminated(spark.createDataFrame(rows, SCHEMA), items).collect()
    assert len(got) == len(rows) and {r.item_id for r in got} == {1}


def test_every_verbatim_window_is_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    grams = {}
    for r in items.collect():
        w = brute.words(r.text.lower())
        for i in range(len(w) - decontam.WINDOW + 1):
            grams.setdefault(tuple(w[i:i + decontam.WINDOW]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = brute.words((r.text or "").lower())
        for i in range(len(w) - decontam.WINDOW + 1):
            want |= {(r.doc_id, x) for x in grams.get(tuple(w[i:i + decontam.WINDOW]), ())}
    got = set(_pairs(decontam.contaminated(docs, items)))
    assert want <= got and len(got - want) <= 0.1 * len(want)


def _both_ways(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    both = [decontam.contaminated(docs, items, max_broadcast=n) for n in (0, 10_000)]
    assert sorted(both[0].collect()) == sorted(both[1].collect())
    return _pairs(both[1])


def test_passages_of_names_and_figures_match_as_they_are(spark):
    title = "The Old Man And The Sea By Ernest Hemingway Won The Prize In 1953 For Fiction"
    names = "Anna Berta Clara Dora Emma Frieda Greta Hanna Ida Johanna Klara Lena"
    figures = "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9"
    short = "In 1953 Ernest Hemingway"
    items = list(enumerate((title, names, figures, short)))
    rows = [(10, f"They said: {title}. So it was"), (11, f"with {names} and others"), (12, f"digits {figures} of pi"),
            (13, f"it was {short} who won"),
            # Other names or figures in the same places are no copy.
            (20, "The Old Dog And The Hut By Maria Sanders Won The Prize In 1961 For Drama"),
            (21, "with Nora Olga Paula Rosa Sara Tina Ulla Vera Wilma Xenia Yvonne Zoe and others"),
            (22, "digits 2 7 1 8 2 8 1 8 2 8 4 5 9 0 4 of e"), (23, "it was In 1961 Maria Sanders who won")]
    assert _both_ways(spark, rows, items) == [(10, 0), (11, 1), (12, 2), (13, 3)]


def test_lower_case_and_shouted_copies_of_passages_with_names(spark):
    text = "On monday Anna Weber met Carl Stone in Vienna and Paul Kern sang for Rosa Lind at noon."
    rows = [(10, "so " + text.lower()), (11, "SO " + text.upper()), (12, "so " + text.replace("On", "on")),
            (13, "so on monday someone met another in a town and nobody sang for anyone at noon")]
    assert _both_ways(spark, rows, [(1, text)]) == [(10, 1), (11, 1), (12, 1)]


def test_figures_with_attached_units(spark):
    items = [(1, "the parcel of 5kg went 120km by road before the 2nd driver took over")]
    rows = [(10, "the parcel of 7kg went 90km by road before the 3rd driver took over"),
            (11, "the parcel of 7 kg went 90 km by road before the 3RD driver took over"),
            (12, "the parcel of xkg went zkm by road before the 3rd driver took over")]
    assert _both_ways(spark, rows, items) == [(10, 1), (11, 1)]
    docs = spark.createDataFrame(rows[:1], "doc_id long, text string")
    got = decontam.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r.first_word, r.end_word) for r in got] == [(0, 14)]


def test_items_of_one_or_two_words_match_whole_texts(spark):
    items = [(1, "yes"), (2, "New York"), (3, "7"), (4, "three words here")]
    rows = [(10, "yes"), (11, " Yes. "), (12, "he said yes and went"), (13, "New York"), (14, "a day in New York"),
            (15, "7"), (16, "8"), (17, "7 of them"), (18, "we have three words here too")]
    assert _both_ways(spark, rows, items) == [(10, 1), (11, 1), (13, 2), (15, 3), (18, 4)]


def test_large_ids_beside_null_ids(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(2**53 + 1, text), (None, text), (3, "other")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(2**53 + 3, text), (None, text + " more")], "item_id long, text string").coalesce(1)
    for limit in (decontam.MAX_BROADCAST, 1):
        got = decontam.contaminated(docs, items, max_broadcast=limit).collect()
        assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(
            [(d, i) for d in (2**53 + 1, None) for i in (2**53 + 3, None)], key=str)


def test_units_only_beside_figures(spark):
    item = "the train covers 90 km in a day and rests for 6 hours before it returns"
    texts = [item.replace("90 km", "75 miles").replace("6 hours", "8 minutes"),       # re-parameterised
             item.replace("a day", "s foot"),                                         # other words, no units here
             "12 " + item]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_windows for r in decontam.contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    # A unit that starts a window has no figure before it there and counts as a word.
    assert got[2] == 7 and got[0] == 6 and got.get(1, 0) < 6


def test_rows_of_words_are_those_of_their_tokens(monkeypatch):
    """The table against ``template_token`` word by word, also when the cache starts again;
    words without figure or unit are not matched against patterns."""
    import random
    import xxhash
    rng = random.Random(3)
    pieces = ["a", "km", "Anna", "USA", "ß", "Ω", "𝐀b", "ǅx", "x1", "12", "5kg", "3rd", "-", "'", ".", "!", "\"", "%", "$", "é", "İ", ","]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))) for _ in range(4000)]

    def digest(x):
        return xxhash.xxh64_intdigest(x)

    def want(text):
        parts = decontam.with_unit(text)
        token, slot, name, ends = decontam.template_token(parts[0] if parts else text)
        core = text.strip(decontam._EDGES)
        return [digest(token), 0 if slot is None else digest(slot) | 1, digest(core) | 1 if name else 0,
                int(decontam.template_token(text)[3] if parts else ends), digest(parts[1].lower()) | 1 if parts else 0,
                digest(core.lower()) if token == decontam.UNIT else 0]

    monkeypatch.setattr(decontam._Coder, "LIMIT", 500)
    coder = decontam._Coder()
    for lo in range(0, len(texts), 100):
        part = texts[lo:lo + 100]
        assert coder.rows([t.encode() for t in part]).tolist() == [want(t) for t in part]
    calls = []
    monkeypatch.setattr(decontam, "template_token", lambda word: calls.append(word))
    decontam._Coder().rows([f"{a}{b}{c}".encode() for a in "abcX" for b in "klm" for c in ("op", "pq,", "qr.")])
    assert not calls


def test_words_of_texts_are_cut_at_ascii_white_space(monkeypatch):
    import pyarrow as pa
    texts = ["", None, " ", "one", " a  b\t", "".join(f"w{chr(c)}" for c in range(1, 256)), "x\u2003y\u00a0z\x85 ä",
             "\n\none two", "one " * 50, "end"]
    for size in (1, 20, 1 << 20):
        monkeypatch.setattr(decontam, "PART_BYTES", size)
        coder = decontam._Coder()
        got = list(coder.texts(pa.array(texts)))
        assert len(got) == len(texts) and list(coder.texts(pa.array([], pa.string()))) == []
        for t, rows in zip(texts, got):
            assert rows.tolist() == coder.rows((t or "").encode().split()).tolist()
