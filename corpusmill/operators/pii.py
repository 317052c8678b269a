"""Personal-data detection and surrogate replacement.

Every step is a Column expression over one row's text: per-type regex spans,
a context-word check for types that need one, person names by honorific or
a given-name list, distinct union, a total order, covers of overlapping
mentions, and one left-to-right replacement that also moves the offsets.
The surrogate of a mention is a pure function of ``(seed, tag, mention)``,
so the same mention gets the same value in every row and every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import spans as SP
from ..functions.arrays import chunks, let, posexplode_rows, scan_array
from ..functions.rules import ContextRules
from ..functions.text import lang_base
from .sampling import hash_int

# Parts of PERSON surrogates: given name, initial, family name (10,400 of them).
SURROGATE_GIVEN = ("Alex", "Sam", "Jordan", "Robin", "Casey", "Jamie", "Morgan", "Taylor", "Avery", "Riley",
                   "Quinn", "Rowan", "Skyler", "Dana", "Jesse", "Kerry", "Leslie", "Marion", "Noel", "Pat")
SURROGATE_FAMILY = ("Morgan", "Taylor", "Lee", "Park", "Quinn", "Rivera", "Blake", "Reed", "Stone", "Hayes",
                    "Brooks", "Carter", "Dale", "Ellis", "Frost", "Grant", "Hale", "Irving", "Jarvis", "Knox")
INITIALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _empty_spans() -> Column:
    return F.array().cast(f"array<{SP.SPAN_TYPE}>")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


RULES = ContextRules()


def has_context(text, span, lang, tag: str, window: int, rules: ContextRules = RULES) -> Column:
    """a context word of the language within ``window`` characters."""
    ctx = SP.context_of(text, span, window)

    def found(lg):
        p = rules.pattern(tag, lg)
        return ctx.rlike(p) if p else F.lit(False)

    expr = None
    for lg in rules.languages(tag):
        expr = F.when(lang == F.lit(lg), found(lg)) if expr is None else expr.when(lang == F.lit(lg), found(lg))
    return found(None) if expr is None else expr.otherwise(found(None))


def detect_type(text, lang, tag: str, context_window: int = 20, rules: ContextRules = RULES) -> Column:
    """F1a-g: spans of one regex type (context-filtered where required)."""
    t = _col(text)

    def near(s):
        return has_context(t, s, lang, tag, context_window, rules)

    if (either := P.either_pattern(tag)) is not None:       # both kinds in one pass
        pattern, strong = either
        return F.filter(SP.regex_spans(text, pattern, tag), lambda s: F.when(
            s["end"] - s["start"] >= strong, True).otherwise(near(s)))
    spans = SP.regex_spans(text, P.detector_pattern(tag, "java"), tag, P.detector_group(tag), P.JAVA_BEFORE.get(tag))
    if tag in P.NEEDS_CONTEXT:
        spans = F.filter(spans, near)
    if tag in P.WITH_CONTEXT:
        spans = F.concat(spans, F.filter(SP.regex_spans(text, P.weak_pattern(tag, "java"), tag), near))
    if tag in ("EMAIL", "USER"):          # cheap guard before the regex passes
        spans = F.when(t.contains("@"), spans).otherwise(_empty_spans())
    return spans


def detect_person_names(text) -> Column:
    """F4 (re-aimed): ``Given Surname`` pairs from a fixed given-name list."""
    return SP.regex_spans(text, P.name_list_pattern("java"), "PERSON", 0)


def may_hold(text, tags: Iterable[str]) -> Column:
    """False only where the patterns of ``tags`` find nothing (NULL for a NULL text)."""
    t, tags = _col(text), set(tags)
    tests = [t.contains(x) for x in sorted({P.HELD_TEXT[tag] for tag in tags if tag in P.HELD_TEXT})]
    tests += [t.rlike(p) for p in [P.held_pattern(tags), *(P.HELD_RUN[tag] for tag in sorted(tags) if tag in P.HELD_RUN)] if p]
    known = set(P.HELD_TEXT) | set(P.HELD_BY) | set(P.HELD_RUN)
    if not tests or any(tag in P.DETECTORS and tag not in known for tag in tags):
        return F.lit(True)
    out = tests[0]
    for x in tests[1:]:
        out = out | x
    return out


def detect(text, lang=None, tags: Iterable[str] | None = P.DEFAULT_TAGS,
           context_window: int = 20,
           extra_detectors: Iterable[Callable[[Column, Column], Column]] = (),
           rules: ContextRules = RULES, more_spans=None) -> Column:
    """sorted, distinct mentions; overlapping ones become one cover.

    ``text`` is a column name.  ``more_spans`` is a column of spans found elsewhere (names of a table, ``names``).

    ``tags=None`` means every known type.  ``extra_detectors`` are plug-ins
    (U2) returning ``array<struct<start,end,text,tag>>`` for ``(text, lang)``,
    typically an iterator pandas UDF that loads a model once per task.
    """
    lg = lang_base(_col(lang)) if lang is not None else F.lit("en")
    tags = list(P.DETECTORS) if tags is None else list(tags)
    parts = [detect_type(text, lg, tag, context_window, rules) for tag in tags if tag in P.DETECTORS]
    if "PERSON" in tags:
        parts.append(detect_person_names(text))
    if parts:                             # most texts have no mention and go through one quick search
        parts = [F.when(~may_hold(text, tags), _empty_spans()).otherwise(F.concat(*parts) if len(parts) > 1 else parts[0])]
    parts += [d(_col(text), lg) for d in extra_detectors]
    if more_spans is not None:
        parts.append(_col(more_spans))
    if not parts:
        return _empty_spans()
    union = F.concat(*parts) if len(parts) > 1 else parts[0]
    return let(union, lambda found: F.when(F.size(found) == 0, _empty_spans()).otherwise(
        SP.covering_spans(SP.sort_spans(found, P.TAG_PRIORITY), P.TAG_PRIORITY)))


def surrogate(tag, mention, seed: int = 0) -> Column:
    """a made-up value of the same type, stable for ``(seed, tag, mention)``."""
    tg, m = _col(tag), _col(mention)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), tg, m))
    h = hash_int(F.lit(str(seed)), tg, m)
    own = F.substring(key, 9, 12)         # 48 bits: two handles or addresses stay two

    def digits(x, n):
        return F.lpad(x.cast("string"), n, "0")

    def part(div, mod):
        return (F.floor(h / F.lit(div)).cast("bigint") % F.lit(mod))

    def one_of(names, div):
        return F.element_at(F.array(*[F.lit(n) for n in names]), (part(div, len(names)) + 1).cast("int"))

    n_g, n_f = len(SURROGATE_GIVEN), len(SURROGATE_FAMILY)
    person = F.concat_ws(" ", one_of(SURROGATE_GIVEN, 1), F.concat(one_of(INITIALS, n_g * n_f), F.lit(".")), one_of(SURROGATE_FAMILY, n_g))
    return (F.when(tg == "EMAIL", F.concat(F.lit("user"), own, F.lit("@example.com")))
            .when(tg == "IP_ADDRESS", F.concat_ws(".", F.lit("10"), (h % 256).cast("string"),
                                                  part(256, 256).cast("string"),
                                                  part(65536, 256).cast("string")))
            .when(tg == "PHONE", F.concat(F.lit("555-"), digits(h % 1000, 3), F.lit("-"),
                                          digits(part(1000, 10000), 4)))
            .when(tg == "KEY", F.md5(F.concat(F.lit(f"{seed}:key:"), m)))
            .when(tg == "ID", digits(h % 1000000000, 9))
            .when(tg == "USER", F.concat(F.lit("@user"), own))
            .when(tg == "LICENSE_PLATE", F.concat(F.lit("XY "), digits(h % 10000, 4)))
            .when(tg == "PERSON", person)
            .otherwise(F.lit("[REDACTED]")))


def replace_mentions(text, mentions, seed: int = 0) -> Column:
    """F7+F8: ``struct<text, ner>`` with surrogates in place and moved offsets.

    ``mentions`` must be sorted and non-overlapping (``detect`` output).
    """
    t = _col(text)
    ks = F.transform(_col(mentions), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        s["tag"].alias("tag"), surrogate(s["tag"], s["text"], seed).alias("sur")))
    place = "struct<prev:bigint,start:bigint,end:bigint,sur:string,new:bigint,tag:string>"
    init = F.struct(F.lit(0).cast("bigint").alias("prev"), F.lit(0).cast("bigint").alias("shift"))

    def step(st, x):
        ln = F.length(x["sur"]).cast("bigint")
        placed = F.struct(st["prev"].alias("prev"), x["start"].alias("start"), x["end"].alias("end"), x["sur"].alias("sur"),
                          (x["start"] + st["shift"]).alias("new"), x["tag"].alias("tag"))
        return (F.struct(x["end"].alias("prev"), (st["shift"] + ln - (x["end"] - x["start"])).alias("shift")),
                F.array(placed))

    def rewritten(t, ps):
        """Texts between mentions are cut from the part of the text that a piece of
        mentions covers: cutting counts characters from the start of what it cuts."""
        def piece(c):
            base, last = F.get(c, F.lit(0))["prev"], F.element_at(c, -1)["end"]
            return let(t.substr(base + 1, last - base), lambda own: F.array_join(F.transform(c, lambda x: F.concat(
                own.substr(x["prev"] - base + 1, x["start"] - x["prev"]), x["sur"])), ""))

        tail = t.substr(F.element_at(ps, -1)["end"] + 1, F.length(t) + 1)
        new = F.concat(F.array_join(F.transform(chunks(ps), piece), ""), tail)
        ner = F.transform(ps, lambda x: F.struct(
            x["new"].alias("start"), (x["new"] + F.length(x["sur"])).cast("bigint").alias("end"),
            x["sur"].alias("text"), x["tag"].alias("tag")))
        return F.when(F.size(ps) == 0, F.struct(t.alias("text"), _empty_spans().alias("ner"))).otherwise(
            F.struct(new.alias("text"), ner.alias("ner")))

    # Most texts have no mention and are not folded.
    return F.when(F.size(_col(mentions)) == 0, F.struct(t.alias("text"), _empty_spans().alias("ner"))).otherwise(
        let(F.struct(t.alias("t"), scan_array(ks, init, step, place).alias("ps")), lambda v: rewritten(v["t"], v["ps"])))


def anonymize_column(text, lang=None, context_window: int = 20, condition=True,
                     tags=P.DEFAULT_TAGS, seed: int = 0, extra_detectors=()) -> Column:
    """the document struct ``<text, ner, orig_text, orig_ner>``.

    ``condition`` (P8) is a bool or a boolean Column; when false the text
    passes through and ``orig_*`` are NULL.
    """
    return document(text, detect(text, lang, tags, context_window, extra_detectors),
                    condition, seed)


def document(text, ner, condition=True, seed: int = 0) -> Column:
    """Build the output struct from a text and its mentions."""
    t, ner = _col(text), _col(ner)
    new = replace_mentions(t, ner, seed)
    cond = condition if isinstance(condition, Column) else F.lit(bool(condition))
    return (F.when(cond, F.struct(new["text"].alias("text"), new["ner"].alias("ner"),
                                  t.alias("orig_text"), ner.alias("orig_ner")))
            .otherwise(F.struct(t.alias("text"), ner.alias("ner"),
                                F.lit(None).cast("string").alias("orig_text"),
                                F.lit(None).cast(f"array<{SP.SPAN_TYPE}>").alias("orig_ner"))))


def anonymize(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang",
              context_window: int = 20, condition=True, tags=P.DEFAULT_TAGS, seed: int = 0,
              extra_detectors=(), out_col: str = "doc", rules: ContextRules = RULES, more_spans=None) -> DataFrame:
    """F9/F10 as a DataFrame transform: adds the ``doc`` struct column."""
    lang = F.col(lang_col) if lang_col else None
    ner = detect(text_col, lang, tags, context_window, extra_detectors, rules, more_spans)
    return (df.withColumn("_ner", ner)
            .withColumn(out_col, document(text_col, "_ner", condition, seed))
            .drop("_ner"))


def anonymize_text(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang",
                   **kw) -> DataFrame:
    """replace ``text_col`` by its anonymized text (what a dataset map does)."""
    return (anonymize(df, text_col, lang_col, out_col="_doc", **kw)
            .withColumn(text_col, F.col("_doc.text")).drop("_doc"))


# Python's str.splitlines boundaries (P10): \n, \r, \r\n, \v, \f, \x1c-\x1e,
# \x85, \u2028, \u2029.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def splitlines(text) -> Column:
    """P10: ``str.splitlines()`` (no trailing empty piece; '' -> [])."""
    parts = F.split(_col(text), LINE_BREAK, -1)
    return F.when(F.try_element_at(parts, F.size(parts)) == "",
                  F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def anonymize_lines(df: DataFrame, group_cols: list[str], order_col: str, text_col: str = "text",
                    lang_col: str | None = None, **kw) -> DataFrame:
    """P10: list-of-texts path.  Lines of one group are joined with ``\\n``,
    anonymized once, and split back with ``splitlines``.  A group is one
    article, so its size is bounded by that article.
    """
    agg = [F.array_sort(F.collect_list(F.struct(order_col, text_col))).alias("_lines")]
    if lang_col:
        agg.append(F.min_by(lang_col, order_col).alias(lang_col))
    g = (df.groupBy(*group_cols).agg(*agg)
         .withColumn("_joined", F.array_join(F.transform("_lines", lambda x: x[text_col]), "\n")))
    # A column of its own: ``splitlines`` names its argument several times.
    g = anonymize(g, "_joined", lang_col, out_col="_doc", **kw).withColumn("_text", F.col("_doc.text"))
    return (posexplode_rows(g, group_cols, splitlines(F.col("_text")), "line_idx", text_col)
            .withColumn("line_idx", F.col("line_idx").cast("bigint")))


def mentions_long(df: DataFrame, id_cols: list[str], spans_col: str) -> DataFrame:
    """Long form ``(ids..., idx, start, end, mention, tag)`` of a span array."""
    return (posexplode_rows(df, id_cols, F.col(spans_col), "idx", "s")
            .select(*id_cols, F.col("idx").cast("bigint").alias("idx"),
                    F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                    F.col("s.text").alias("mention"), F.col("s.tag").alias("tag")))
