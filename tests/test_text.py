"""Golden rows for sentence extraction (FIXTURES.md 4.1, 4.2)."""

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import sentences as S

CASES = [
    ("Café rules – open daily.  Bring   cash! Thanks.",
     ["Caf rules open daily.", "Bring cash!", "Thanks."]),
    ("Head\n\n1920 | First cup (1st) 1924 | Second cup (2nd) 1927\n ab \n a b ",
     ["Head", "1920", "First cup (1st) 1924", "Second cup (2nd) 1927", "a b"]),
    ("Ask A. Smith or Dr. Jones. They know.",
     ["Ask A. Smith or Dr. Jones.", "They know."]),
    ('One line?  (Yes.) "Quoted end." Next one. and lower stays.',
     ["One line?", "(Yes.)", '"Quoted end."', "Next one. and lower stays."]),
    ("北京\néé", []),
    ("", []),
    ("a – b and 1543 – ) ok", ["a b and 1543 ) ok"]),
]


def test_extract_sentences_golden(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, text string")
    got = {r.id: r.s for r in df.select("id", T.extract_sentences("text").alias("s")).collect()}
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, (i, got[i], want)


def test_space_filter_bounds(spark):
    rows = [(" ".join(["w"] * (n + 1)),) for n in (4, 5, 200, 201)]
    df = spark.createDataFrame(rows, "text string")
    keep = [r.k for r in df.select(T.spaces_between("text", 5, 200).alias("k")).collect()]
    assert keep == [False, True, True, False]
    keep = [r.k for r in df.select(T.spaces_between("text", None, 200).alias("k")).collect()]
    assert keep == [True, True, True, False]


def test_lang_base(spark):
    df = spark.createDataFrame([("en_US",), ("zh",)], "lang string")
    assert [r.b for r in df.select(T.lang_base("lang").alias("b")).collect()] == ["en", "zh"]


def test_transliterate(spark):
    df = spark.createDataFrame([("Straße Ærø café naïve",)], "t string")
    got = df.select(T.clean_ascii("t", True).alias("c")).first().c
    assert got == "Strasse AEro cafe naive"


def test_sentences_posexplode_matches_arrays(spark):
    df = spark.createDataFrame([(1, "Hello there my good friend. Another sentence comes right here now.")],
                               "article_id long, text string")
    rows = S.sentences(df, 5, 200).orderBy("sent_idx").collect()
    assert [r.text for r in rows] == ["Another sentence comes right here now."]
    assert [r.sent_idx for r in rows] == [0]


def test_marks_in_a_line_survive_sentence_splitting(spark):
    line = "One\x01 two\x02a. Dr. Who came\x02.  \x01Next one. And\x02c\x01"
    df = spark.createDataFrame([(line,), (line.replace("\x01", "").replace("\x02", ""),)], "t string")
    marked, plain = (r.s for r in df.select(T.split_sentences("t").alias("s")).collect())
    strip = str.maketrans("", "", "\x01\x02")
    assert [x.translate(strip) for x in marked] == plain and len(plain) == 4
    assert "".join(marked).replace(" ", "") == line.replace(" ", "")


def test_abbreviations_found_from_their_period(spark):
    from pyspark.sql import functions as F
    from corpusmill.functions import patterns as P
    texts = ["A. B. c. Dr. No. xNo. etc.", "(St. Mr.Mrs. vs. 1. -a. a.b. e.g. ", ".", "Z.", " .. A..", "\tA. (Dr.)."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    at_start, at_dot = P.abbreviation_pattern(), P.abbreviation_dot()
    assert all(r.a == r.b for r in df.select(F.regexp_replace("t", at_start, "$1$2#").alias("a"),
                                             F.regexp_replace("t", at_dot, "#").alias("b")).collect())
    assert P.abbreviation_dot(("x+",)) is None
