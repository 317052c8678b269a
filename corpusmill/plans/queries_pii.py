"""Checked queries for personal-data detection and anonymization."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import spans as SP
from ..functions.text import lang_base
from ..functions.arrays import explode_rows, posexplode_rows
from ..functions.rules import NAME_ROWS, names_table
from ..operators import pii as PII
from ..operators.names import detect_names
from ..sources.tables import table, text_table
from . import oracle_pii as OP
from .build_splits import TEST_BUDGETS, build_splits
from .queries_splits import SEED, _articles, _split_sql
from .oracle_text import kept_sentences, q
from .registry import register

WINDOW = 20


def _docs(spark, sf_dir):
    return text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text", "lang")


def _marked(spark, sf_dir):
    """Documents with a handle, a plate, names and overlapping mentions added."""
    return _docs(spark, sf_dir).withColumn("text", OP.marked_text("text", "doc_id"))


_MARKED = OP.documents_src(text=OP.MARKED_SQL)


def _explode(df, spans, extra=()):
    return (explode_rows(df, ["doc_id"], spans, "s")
            .select("doc_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                    F.col("s.text").alias("mention"), *extra))


# ------------------------------------------------------------ per-type spans
_TYPE_QUERIES = {"pii_email": "EMAIL", "pii_ip": "IP_ADDRESS", "pii_phone": "PHONE",
                 "pii_key": "KEY", "pii_id": "ID", "pii_user": "USER",
                 "pii_plate": "LICENSE_PLATE"}


_ADDED = ("USER", "LICENSE_PLATE")          # the supplied texts hold none


def _type_query(tag):
    def run(spark, sf_dir):
        d = (_marked if tag in _ADDED else _docs)(spark, sf_dir)
        return _explode(d, PII.detect_type("text", lang_base("lang"), tag, WINDOW))
    return run


for _name, _tag in _TYPE_QUERIES.items():
    register(_name, f"""WITH {_MARKED if _tag in _ADDED else OP.documents_src()}
SELECT _k AS doc_id, start, "end", mention FROM {OP.type_sql(_tag, WINDOW)}""")(_type_query(_tag))


@register("pii_person", f"""WITH {_MARKED}
SELECT _k AS doc_id, start, "end", mention FROM {OP.person_sql()}""")
def q_pii_person(spark, sf_dir):
    d = _marked(spark, sf_dir)
    spans = F.array_distinct(F.concat(PII.detect_type("text", lang_base("lang"), "PERSON"),
                                      PII.detect_person_names("text")))
    return _explode(d, spans)


# Names of people, places and things: capitalised words inside benchmark sentences.
_BENCH_NAME = "[a-z,] ([A-Z][a-z]+)"
_NAME_WORDS = max(n.count(" ") + 1 for n, _ in NAME_ROWS)
_NAMES_SQL = f"""names AS (SELECT * FROM (VALUES {", ".join(f"({q(n)}, {q(lg)})" for n, lg in NAME_ROWS)}) t(name, lang)
  UNION SELECT DISTINCT unnest(regexp_extract_all(text, {q(_BENCH_NAME)}, 1)), '*' FROM benchmark)"""


@register("pii_name_table", f"""WITH {_MARKED}, {_NAMES_SQL}
SELECT _k AS doc_id, start, "end", mention FROM {OP.names_sql("names", _NAME_WORDS)}""")
def q_pii_name_table(spark, sf_dir):
    """the packaged names and those of the benchmark, looked up in every text."""
    d = _marked(spark, sf_dir).withColumn("lang", lang_base("lang"))
    bench = table(spark, sf_dir, "benchmark", "text")
    names = names_table(spark).unionByName(explode_rows(
        bench, [], F.regexp_extract_all("text", F.lit(_BENCH_NAME), F.lit(1)), "name").distinct().withColumn("lang", F.lit("*")))
    return detect_names(d, ["doc_id"], names, "text", "lang")


@register("pii_context", f"""WITH {_MARKED}
SELECT _k AS doc_id, start, "end", mention,
       CAST(CASE WHEN {OP.context_sql('LICENSE_PLATE', WINDOW)} THEN 1 ELSE 0 END AS BIGINT) AS has_context
FROM {OP.spans_sql('LICENSE_PLATE')}""")
def q_pii_context(spark, sf_dir):
    d = _marked(spark, sf_dir).withColumn("lb", lang_base("lang"))
    spans = SP.regex_spans("text", P.detector_pattern("LICENSE_PLATE"), "LICENSE_PLATE")
    flagged = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"),
        PII.has_context(F.col("text"), s, F.col("lb"), "LICENSE_PLATE", WINDOW)
        .cast("int").cast("bigint").alias("has_context")))
    return _explode(d, flagged, [F.col("s.has_context").alias("has_context")])


@register("mention_union", f"""WITH {OP.documents_src()}
SELECT DISTINCT _k AS doc_id, start, "end", mention, tag FROM {OP.candidates_sql(P.DEFAULT_TAGS, WINDOW)}""")
def q_mention_union(spark, sf_dir):
    d = _docs(spark, sf_dir)
    lb = lang_base("lang")
    parts = [PII.detect_type("text", lb, t, WINDOW) for t in P.DEFAULT_TAGS]
    parts.append(PII.detect_person_names("text"))
    return _explode(d, F.array_distinct(F.concat(*parts)), [F.col("s.tag").alias("tag")])


# ------------------------------------------------------------ resolved mentions
@register("pii_mentions", f"""WITH {OP.documents_src()}, {OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)}
SELECT _k AS doc_id, idx, start, "end", mention, tag FROM kept""")
def q_pii_mentions(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("ner", PII.detect("text", F.col("lang"), P.DEFAULT_TAGS, WINDOW))
    return PII.mentions_long(d, ["doc_id"], "ner")


@register("pii_by_type", f"""WITH {OP.documents_src()}, {OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)},
t AS (SELECT * FROM (VALUES {", ".join(f"('{t}')" for t in P.DEFAULT_TAGS)}) v(tag))
SELECT t.tag, CAST(count(kept.tag) AS BIGINT) AS n_mentions,
       CAST(count(DISTINCT kept._k) AS BIGINT) AS n_docs
FROM t LEFT JOIN kept ON kept.tag = t.tag GROUP BY t.tag""")
def q_pii_by_type(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("ner", PII.detect("text", F.col("lang"), P.DEFAULT_TAGS, WINDOW))
    m = PII.mentions_long(d, ["doc_id"], "ner")
    tags = spark.createDataFrame([(t,) for t in P.DEFAULT_TAGS], "tag string")
    agg = m.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("nd"))
    return (tags.join(F.broadcast(agg), "tag", "left")
            .select("tag", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_mentions"),
                    F.coalesce("nd", F.lit(0)).cast("bigint").alias("n_docs")))


# ------------------------------------------------------------ replacement
@register("anonymize", f"""WITH {OP.documents_src()}, {OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)}
SELECT _k AS doc_id, text, n_mentions FROM anon""")
def q_anonymize(spark, sf_dir):
    out = PII.anonymize(_docs(spark, sf_dir), "text", "lang", WINDOW, True, P.DEFAULT_TAGS, SEED)
    return out.select("doc_id", F.col("doc.text").alias("text"),
                      F.size("doc.ner").cast("bigint").alias("n_mentions"))


@register("anonymize_overlaps", f"""WITH {_MARKED}, {OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)}
SELECT _k AS doc_id, text, n_mentions FROM anon""")
def q_anonymize_overlaps(spark, sf_dir):
    out = PII.anonymize(_marked(spark, sf_dir), "text", "lang", WINDOW, True, P.DEFAULT_TAGS, SEED)
    return out.select("doc_id", F.col("doc.text").alias("text"),
                      F.size("doc.ner").cast("bigint").alias("n_mentions"))


@register("anonymize_mentions", f"""WITH {OP.documents_src()}, {OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)}
SELECT _k AS doc_id, idx, tag, mention, start, "end", sur AS surrogate, new_start,
       CAST(new_start + length(sur) AS BIGINT) AS new_end FROM rep""")
def q_anonymize_mentions(spark, sf_dir):
    out = PII.anonymize(_docs(spark, sf_dir), "text", "lang", WINDOW, True, P.DEFAULT_TAGS, SEED)
    z = posexplode_rows(out, ["doc_id"], F.arrays_zip(F.col("doc.orig_ner").alias("o"),
                                                      F.col("doc.ner").alias("n")), "idx", "p")
    return z.select("doc_id", F.col("idx").cast("bigint").alias("idx"),
                    F.col("p.o.tag").alias("tag"), F.col("p.o.text").alias("mention"),
                    F.col("p.o.start").alias("start"), F.col("p.o.end").alias("end"),
                    F.col("p.n.text").alias("surrogate"), F.col("p.n.start").alias("new_start"),
                    F.col("p.n.end").alias("new_end"))


@register("anonymize_conditional", f"""WITH {OP.documents_src("lang = 'en'")},
{OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)}
SELECT src.doc_id, CASE WHEN src.cond THEN anon.text ELSE src.text END AS text,
       CAST(CASE WHEN src.cond THEN 1 ELSE 0 END AS BIGINT) AS anonymized
FROM src JOIN anon ON anon._k = src._k""")
def q_anonymize_conditional(spark, sf_dir):
    cond = F.col("lang") == "en"
    out = PII.anonymize(_docs(spark, sf_dir), "text", "lang", WINDOW, cond, P.DEFAULT_TAGS, SEED)
    return out.select("doc_id", F.col("doc.text").alias("text"),
                      F.col("doc.orig_text").isNotNull().cast("int").cast("bigint").alias("anonymized"))


_SENT_SRC = """, src AS (SELECT split || ':' || CAST(article_id AS VARCHAR) || ':' || CAST(sent_idx AS VARCHAR) AS _k,
                split, article_id, sent_idx, text, 'en' AS lang FROM d),"""


# Every row of every split: the last budget takes the rest of the corpus.
_WHOLE = {**TEST_BUDGETS, "test": 1048576.0}


@register("anonymize_dataset", _split_sql(_WHOLE) + _SENT_SRC
          + OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED) + """
SELECT src.split, src.article_id, src.sent_idx, anon.text FROM src JOIN anon ON anon._k = src._k""")
def q_anonymize_dataset(spark, sf_dir):
    b = build_splits(_articles(spark, sf_dir), _WHOLE, True, SEED, 5, 200)
    return PII.anonymize_text(b.sentences, "text", None, context_window=WINDOW, seed=SEED).select(
        "split", "article_id", "sent_idx", "text")


_LINES_RE = PII.LINE_BREAK


@register("anonymize_grouped", f"""WITH s AS (SELECT doc_id, {kept_sentences('text')} AS sents FROM documents),
src AS (SELECT doc_id AS _k, array_to_string(sents, chr(10)) AS text, 'en' AS lang
        FROM s WHERE len(sents) > 0),
{OP.anonymize_ctes(P.DEFAULT_TAGS, WINDOW, SEED)},
sp AS (SELECT _k, string_split_regex(text, '{_LINES_RE}') AS parts FROM anon),
tr AS (SELECT _k, CASE WHEN parts[len(parts)] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS ls FROM sp)
SELECT _k AS article_id, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_idx, unnest(ls) AS text
FROM tr""")
def q_anonymize_grouped(spark, sf_dir):
    from ..operators.sentences import sentences
    sents = sentences(_articles(spark, sf_dir), 5, 200)
    return PII.anonymize_lines(sents, ["article_id"], "sent_idx", "text", None,
                               context_window=WINDOW, seed=SEED)

