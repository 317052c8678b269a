"""License detection by ordered signature rules, in SQL functions only.

1. A text becomes its words, lower-cased in A-Z, each between two spaces of its
   own, so that neighbouring matches share no character.
2. One pass finds the rule keywords of the text; only rules whose keyword is there run
   (``license_rules``), and give the lengths of their matches and of the gaps between.
3. The narrow result is written; matches become rows, a window adds up their
   places, and a second one suppresses a detection that lies inside another
   of its own tier or a stronger one (equal places: the earlier rule
   wins).  Running maxima of the ends, one a tier, decide that in one sorted pass,
   so a text with very many matches costs no more than sorting them.
4. Labels and score come back per text.  The score is that of the strongest tier left.

Base phrases are counted apart and never suppressed.

Defined results: null, empty and wordless texts have no words, no labels and
score 0; first_word and last_word are then null.  Rows are told apart by a
number of their own, so null and repeated ids and repeated rows each keep
their row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import materialize
from corpusmill.llm.license_rules import rules

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
LETTER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
# Score of the strongest tier that is left; the base phrases count as titles.
SCORES = {1: 1.0, 2: 0.9, 3: 0.75, 4: 0.4}
BASE_TIER = 3


def spaced(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def spaced_words(text: Column) -> Column:
    """The words of a text, each between two spaces of its own."""
    low = F.translate(text, ascii_uppercase, ascii_lowercase)
    # Possessive repeats: no match ever gives a character back.
    out = F.regexp_replace(low, f"{SEPARATOR}*+({LETTER}++){SEPARATOR}*+", " $1 ")
    return F.when(low.rlike(LETTER), out).otherwise(F.lit(""))


def n_words(spaced_text: Column) -> Column:
    """Words of text in that form: half its spaces."""
    gaps = F.length(spaced_text) - F.length(F.replace(spaced_text, F.lit(" "), F.lit("")))
    return F.floor(gaps / 2).cast("long")


def keyword_pattern(keywords) -> str:
    """One alternation of all keywords, by first letter."""
    by_first = {}
    for k in sorted(set(keywords)):
        by_first.setdefault(k[0], []).append(k[1:])
    return " (" + "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in sorted(by_first.items())) + ") "


def _base(t: Column) -> Column:
    """Per base phrase struct<n, first, last, label>; the gaps around its places hold the word counts."""
    out = []
    for phrase, label in PHRASES.items():
        # split() takes a regex; a phrase of letters and spaces stands for itself.
        gaps = F.split(t, spaced(phrase), -1)
        k = phrase.count(" ") + 1
        found = F.struct((F.size(gaps) - 1).cast("long").alias("n"), n_words(F.element_at(gaps, 1)).alias("first"),
                         (n_words(t) - n_words(F.element_at(gaps, -1)) - k).alias("last"), F.lit(label).alias("label"))
        out.append(F.when(F.contains(t, F.lit(spaced(phrase))), found))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _matches(t: Column, table: list) -> Column:
    """array<struct<rule, tier, parts: array<struct<gap, len>>>> of the rules that match."""
    keyed = {}
    for number, _, tier, keyword, regex in table:
        keyed.setdefault(keyword, []).append(
            F.struct(F.lit(number).alias("rule"), F.lit(tier).alias("tier"), F.lit(regex).alias("regex")))
    by_word = F.create_map(*[x for k, rs in keyed.items() for x in (F.lit(k), F.array(*rs))])
    words = F.array_distinct(F.regexp_extract_all(t, F.lit(keyword_pattern(keyed)), 1))
    active = F.flatten(F.transform(words, lambda w: F.element_at(by_word, w)))

    def parts(r):
        sizes = F.arrays_zip(
            F.transform(F.split(t, r["regex"], -1), F.length).alias("gap"),
            F.transform(F.regexp_extract_all(t, r["regex"], F.lit(0)), F.length).alias("len"))
        return F.struct(r["rule"].alias("rule"), r["tier"].alias("tier"), sizes.alias("parts"))

    return F.transform(F.filter(active, lambda r: F.rlike(t, r["regex"])), parts)


def scan(docs: DataFrame, table: list) -> DataFrame:
    """One narrow row per text: words, base places, lengths of the rules' matches."""
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                      spaced_words(F.col("text").cast("string")).alias("t"))
    # The lambda binds the spaced text once, however often it is named inside.
    def judged(t):
        return F.struct(F.coalesce(n_words(t), F.lit(0)).cast("long").alias("n_words"), _base(t).alias("base"),
                        _matches(t, table).alias("found"))

    return src.select("rid", "doc_id", F.transform(F.array(F.coalesce("t", F.lit(""))), judged)[0].alias("s")).select("rid", "doc_id", "s.*")


def surviving(found: DataFrame) -> DataFrame:
    """(rid, rule, tier, start, end) of detections inside no other of their tier or a stronger one."""
    hits = found.select("rid", F.explode("found").alias("f")).select(
        "rid", F.col("f.rule").alias("rule"), F.col("f.tier").alias("tier"), F.posexplode("f.parts").alias("i", "p"))
    upto = Window.partitionBy("rid", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # One shuffle: both windows work on the rows of one text.
    spans = hits.repartition("rid").withColumn("end", F.sum(F.col("p.gap") + F.coalesce("p.len", F.lit(0))).over(upto))
    spans = (spans.filter(F.col("p.len").isNotNull())
             .select("rid", "rule", "tier", (F.col("end") - F.col("p.len")).alias("start"), "end"))
    before = (Window.partitionBy("rid").orderBy("start", F.desc("end"), "tier", "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    reach, inside = spans, F.lit(None).cast("long")
    for tier in SCORES:
        reach = reach.withColumn(f"_to{tier}", F.max(F.when(F.col("tier") <= tier, F.col("end"))).over(before))
        inside = F.when(F.col("tier") == tier, F.col(f"_to{tier}")).otherwise(inside)
    return (reach.filter(F.coalesce(inside, F.lit(-1)) < F.col("end"))
            .select("rid", "rule", "tier", "start", "end"))


def detect_licenses(docs: DataFrame, spans: bool = False) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each row.

    With ``spans`` the detections that were left instead: (rid, label, tier, start, end),
    places in the spaced words.
    """
    table = rules()
    rows = materialize(scan(docs, table), "licenses")
    left = surviving(rows.filter(F.size("found") > 0))
    labels = F.array(*[F.lit(r[1]) for r in table])
    left = left.withColumn("label", F.element_at(labels, F.col("rule") + 1))
    if spans:
        return left.select("rid", "label", "tier", "start", "end")
    per_text = left.groupBy("rid").agg(F.collect_set("label").alias("more"), F.min("tier").alias("tier"))
    base = F.transform("base", lambda b: b["label"])
    out = rows.drop("found").join(per_text, "rid", "left").withColumn(
        "tier", F.least("tier", F.when(F.size("base") > 0, BASE_TIER)))
    score = F.element_at(F.create_map(*[F.lit(x) for kv in SCORES.items() for x in kv]), F.col("tier"))
    return out.select(
        "doc_id", "n_words", F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"))
