"""Personal-data rows of FIXTURES.md 4.4 and replacement invariants."""

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import pii

CASES = [
    ("Mail ann@x.org or call (212) 555-0100.",
     [("ann@x.org", 5, 14, "EMAIL"), ("(212) 555-0100", 23, 37, "PHONE")]),
    ("é ping 10.0.0.256 and 10.0.0.25", [("10.0.0.25", 22, 31, "IP_ADDRESS")]),
    ("by @jo_d today", [("@jo_d", 3, 8, "USER")]),
    ("plate ABC 1234 seen", [("ABC 1234", 6, 14, "LICENSE_PLATE")]),
    ("ABC 1234 seen", []),
    ("Dr. Ana Silva spoke", [("Ana Silva", 4, 13, "PERSON")]),
    ("", []),
]


@pytest.fixture(scope="module")
def anon(spark):
    df = spark.createDataFrame([(i, t, "en_US") for i, (t, _) in enumerate(CASES)],
                               "id int, text string, lang string")
    return {r.id: r.doc for r in pii.anonymize(df).select("id", "doc").collect()}


def test_detect_golden(anon):
    for i, (_, want) in enumerate(CASES):
        got = [(m.text, m.start, m.end, m.tag) for m in anon[i].orig_ner]
        assert got == want, (i, got)


def test_replacement_invariants(anon):
    for i, (text, want) in enumerate(CASES):
        doc = anon[i]
        if not want:
            assert doc.text == text
            continue
        for m in doc.orig_ner:
            assert text[m.start:m.end] == m.text
        for m in doc.ner:
            assert doc.text[m.start:m.end] == m.text
        for m, n in zip(doc.orig_ner, doc.ner):
            assert doc.text[n.start:n.end] != m.text
        if "@x.org" in text:
            assert "ann@x.org" not in doc.text
        # text outside mentions unchanged
        outside_old = [text[a.end:b.start] for a, b in zip(doc.orig_ner, doc.orig_ner[1:])]
        outside_new = [doc.text[a.end:b.start] for a, b in zip(doc.ner, doc.ner[1:])]
        assert outside_old == outside_new
        assert text[:doc.orig_ner[0].start] == doc.text[:doc.ner[0].start]


def test_same_mention_same_surrogate(spark):
    df = spark.createDataFrame([(1, "write to bob@mail.com now"), (2, "cc bob@mail.com please")],
                               "id int, text string")
    out = pii.anonymize(df, lang_col=None).select("id", F.col("doc.ner")[0]["text"].alias("s"))
    assert len({r.s for r in out.collect()}) == 1


def test_condition_column(spark):
    df = spark.createDataFrame([(1, "mail a@b.org", "en"), (2, "mail a@b.org", "fr")],
                               "id int, text string, lang string")
    out = {r.id: r.doc for r in pii.anonymize(df, condition=F.col("lang") == "en").collect()}
    assert out[1].orig_text == "mail a@b.org" and out[1].text != out[1].orig_text
    assert out[2].orig_text is None and out[2].text == "mail a@b.org"


def test_overlaps_resolved_leftmost_longest(spark):
    # an ID inside a longer KEY run is dropped; the KEY wins
    df = spark.createDataFrame([(1, "k 1234567890123456789012345678901234 end")], "id int, text string")
    doc = pii.anonymize(df, lang_col=None).first().doc
    assert [(m.tag, m.start, m.end) for m in doc.orig_ner] == [("KEY", 2, 36)]


def test_splitlines(spark):
    df = spark.createDataFrame([("a\nb\r\nc\rd\x0be\n",), ("",), ("x",)], "t string")
    got = [r.l for r in df.select(pii.splitlines("t").alias("l")).collect()]
    assert got == ["a\nb\r\nc\rd\x0be\n".splitlines(), "".splitlines(), ["x"]]


def test_plugin_detector(spark):
    """An extra detector returning spans is merged, sorted and replaced."""
    from corpusmill.functions.spans import regex_spans

    def city(text, lang):
        return regex_spans(text, "Reykjavik", "LOCATION")
    df = spark.createDataFrame([(1, "Ann wrote from Reykjavik to a@b.org")], "id int, text string")
    doc = pii.anonymize(df, lang_col=None, extra_detectors=[city]).first().doc
    assert [(m.tag, m.start, m.end) for m in doc.orig_ner] == [("LOCATION", 15, 24), ("EMAIL", 28, 35)]
    assert "Reykjavik" not in doc.text and "[REDACTED]" in doc.text


LEAKS = ["write Anna Smith@example.com now", "ask Mr. Bob Lee.roe@corp.org ok",
         "id 12345678901234567890123 and @" + "h" * 40, "plate ABC 1234567890 x", "call 555-123-4567@host.org",
         "Dr. Ana Silva 10.0.0.25@x.org, 123456789012345678901234567890123456"]


def test_no_character_of_a_detected_mention_survives(spark):
    """Every raw detection lies inside a final span, and final spans are replaced whole."""
    df = spark.createDataFrame(list(enumerate(LEAKS)), "id int, text string")
    lang = F.lit("en")
    raw = [pii.detect_type("text", lang, t) for t in pii.P.DEFAULT_TAGS] + [pii.detect_person_names("text")]
    rows = pii.anonymize(df.withColumn("raw", F.concat(*raw)), lang_col=None).collect()
    for r in rows:
        assert r.raw
        covers = [(m.start, m.end) for m in r.doc.orig_ner]
        assert covers == sorted(covers) and all(a[1] <= b[0] for a, b in zip(covers, covers[1:]))
        for m in r.raw:
            assert any(s <= m.start and m.end <= e for s, e in covers), (r.text, m)
            assert m.text not in r.doc.text
        for m in r.doc.orig_ner:
            assert r.text[m.start:m.end] == m.text
        outside = "".join(r.text[a:b] for a, b in zip([0] + [e for _, e in covers], [s for s, _ in covers] + [len(r.text)]))
        new = [(m.start, m.end) for m in r.doc.ner]
        assert outside == "".join(r.doc.text[a:b] for a, b in zip([0] + [e for _, e in new], [s for s, _ in new] + [len(r.doc.text)]))
    assert [r.doc.text for r in rows][0].endswith("@example.com now") and "Smith@" not in rows[0].doc.text


def test_very_many_mentions_in_one_text(spark):
    """40,000 mentions cost little more a mention than 10,000; text outside stays."""
    import time
    times = []
    for n in (10000, 40000):
        text = " ".join(f"a{i}@x.org" for i in range(n))
        df = spark.createDataFrame([(text,)], "text string")
        start = time.perf_counter()
        doc = pii.anonymize(df, "text", None).first().doc
        times.append(time.perf_counter() - start)
        assert len(doc.ner) == n and all(doc.text[m.start:m.end] == m.text for m in doc.ner[::997])
        assert [m.start for m in doc.orig_ner[:3]] == [0, 9, 18] and doc.text.count(" ") == n - 1
    assert times[1] < 5 * times[0]


def test_a_language_is_more_rows(spark):
    from corpusmill.functions.rules import CONTEXT_ROWS, ContextRules
    df = spark.createDataFrame([("tablica ABC 1234 tu", "pl"), ("tablica ABC 1234 tu", "en"), ("haslo 0123456789abcdef01 x", "pl")],
                               "text string, lang string")
    own = ContextRules.of_table(spark.createDataFrame(
        [*CONTEXT_ROWS, ("pl", "LICENSE_PLATE", "tablica"), ("pl", "KEY", "haslo")], "lang string, tag string, word string"))

    def tags(**kw):
        return [[m.tag for m in r.ner] for r in df.select(pii.detect("text", F.col("lang"), ("LICENSE_PLATE", "KEY"), **kw).alias("ner")).collect()]

    assert tags() == [[], [], []]
    assert tags(rules=own) == [["LICENSE_PLATE"], [], ["KEY"]]


def test_short_keys_need_a_context_word(spark):
    cases = [("token 0123456789abcdef", 1), ("value 0123456789abcdef", 0), ("value " + "0123456789abcdef" * 2, 1)]
    for text, n in cases:
        got = spark.createDataFrame([(text,)], "text string").select(pii.detect("text", None, ("KEY",)).alias("ner")).first().ner
        assert len(got) == n, text


def test_names_of_a_table(spark, tmp_path, monkeypatch):
    from corpusmill.functions.rules import names_table
    from corpusmill.operators import names as NM
    (tmp_path / "names.csv").write_text("name,lang\nZoë,*\nAnna Lena,de\nAnna,*\n", encoding="utf-8")
    table = names_table(spark, str(tmp_path / "names.csv"))
    rows = [(1, "Zoë Quist met Anna Lena Berg, Anna  Ott and Anna\nBerg.", "de"), (2, "Anna Lena Berg", "en"), (3, None, "de"), (4, "", None),
            (5, "say anna Berg, XAnna Berg, Zoë", "de")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    want = [(1, 0, 9, "Zoë Quist"), (1, 14, 28, "Anna Lena Berg"), (2, 0, 9, "Anna Lena")]
    for limit in (64 << 20, 0):
        monkeypatch.setattr(NM, "BROADCAST_BYTES", limit)
        got = NM.detect_names(df, ["doc_id"], table, "text", "lang").collect()
        assert sorted(map(tuple, got)) == want
    numbered = df.withColumn("_row", F.col("doc_id"))
    out = NM.with_name_spans(numbered, table, "text", "lang")
    doc = pii.anonymize(out.where("doc_id = 1"), "text", "lang", more_spans="name_spans").first().doc
    assert "Quist" not in doc.text and "Berg, Anna  Ott" not in doc.text and doc.text.endswith("Anna\nBerg.")


def test_people_keep_apart(spark):
    text = " and ".join(f"Dr. {a}{b} Smith" for a in ("Ann", "Bob", "Cec", "Dan") for b in ("a", "b", "c", "d", "e"))
    doc = pii.anonymize(spark.createDataFrame([(text,)], "text string"), "text", None).first().doc
    assert len({m.text for m in doc.ner}) >= 19 and len(doc.ner) == 20


# Pieces that meet, overlap and continue each other.
PIECES = ["a", "Z", "7", "4321", "@", ".", "-", " ", "(", ")", "+", "_", "%", "\x00", "\n", "é", "𝒳", "com", "ann@x.org", "b@c.de1d@e.fr", "@jo_d",
          "10.0.0.25", "255.1", "256.", "(212) 555-0100", "212-555-0100", "+1 ", "deadbeef", "0123456789abcdef", "ABC 1234", "AB-12", "plate ",
          "token ", "123456789", "Dr. ", "Mr Ana", " Silva", "Mary Ann", " Smith", "José Perez", "Jürgen Ott"]


def test_java_spellings_find_the_same_mentions(spark):
    """The fast spellings against the plain ones of ``DETECTORS``, on texts of random pieces."""
    import random
    from corpusmill.functions import patterns as P
    from corpusmill.functions.spans import regex_spans
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string").repartition(8)

    def plain(tag, pattern, group=0):
        return regex_spans("text", P._spelled(pattern, "java"), tag, group)

    lang, n = F.lit("en"), 0
    for tag, pattern in P.DETECTORS.items():
        want = plain(tag, pattern, 2 if tag in P.PREFIX_GROUP else 0)
        def near(s):
            return pii.has_context(F.col("text"), s, lang, tag, 20)
        if tag in P.NEEDS_CONTEXT:
            want = F.filter(want, near)
        if tag in P.WITH_CONTEXT:
            want = F.sort_array(F.concat(want, F.filter(plain(tag, P.WITH_CONTEXT[tag]), near)))
        if tag in ("EMAIL", "USER"):
            want = F.when(F.col("text").contains("@"), want).otherwise(F.array().cast(want_type()))
        rows = df.select("text", want.alias("want"), pii.detect_type("text", lang, tag).alias("got")).collect()
        for r in rows:
            assert r.got == r.want, (tag, r.text)
        n = max(n, sum(len(r.got or ()) for r in rows))
        assert any(r.got for r in rows), tag
    assert n > 500


def want_type():
    from corpusmill.functions.spans import SPAN_TYPE
    return f"array<{SPAN_TYPE}>"


def test_long_runs_are_read_once(spark):
    """A run of 150,000 letters beside an address costs no step per pair of its letters."""
    import time
    df = spark.createDataFrame([("x" * 150_000 + " ann@x.org",)], "text string")
    df.select(pii.detect_type("text", F.lit("en"), "EMAIL").alias("e")).first()
    start = time.perf_counter()
    spans = df.select(pii.detect_type("text", F.lit("en"), "EMAIL").alias("e")).first().e
    assert [(s.start, s.text) for s in spans] == [(150_001, "ann@x.org")] and time.perf_counter() - start < 5


def test_texts_without_any_part_of_a_mention_are_passed_by(spark):
    """The quick search lets every mention through, and only it runs on the other texts."""
    from pyspark.sql import functions as F
    from corpusmill.functions import patterns as P
    from corpusmill.operators import pii as PII
    held = {"EMAIL": "a@b.de", "IP_ADDRESS": "1.2.3.4", "PHONE": "(555) 123-4567", "KEY": "a" * 32, "ID": "1" * 9, "USER": "@ab",
            "LICENSE_PLATE": "plate XY 12", "PERSON": "Mme Ab"}
    rows = [(tag, f"so {m} it") for tag, m in held.items()] + [("PERSON", f"{n} Xy") for n in P.GIVEN_NAMES] + [("KEY", "api key " + "f" * 16)]
    plain = "Plain words, Capitals and 12 numbers - nothing else. Mr nobody; abcdef 2-3 A 1st."
    df = spark.createDataFrame(rows, "tag string, text string")
    assert set(held) == set(P.DETECTORS)
    for tag in held:
        mine = df.where(F.col("tag") == tag)
        assert mine.where(PII.may_hold("text", [tag])).count() == mine.where(F.size(PII.detect("text", None, [tag])) > 0).count() == mine.count()
    one = spark.createDataFrame([(plain[:-9],)], "text string")
    assert not one.select(PII.may_hold("text", P.DEFAULT_TAGS)).first()[0]
    null = spark.createDataFrame([(None,)], "text string")
    assert null.select(PII.may_hold("text", P.DEFAULT_TAGS)).first()[0] is None
    assert "CASE WHEN NOT" in one.select(PII.detect("text").alias("d"))._jdf.queryExecution().analyzed().toString()
