"""DuckDB SQL for detection and replacement, from the shared patterns.

The Spark side folds over arrays; this side unnests, takes window sums for
offsets, merges overlapping candidates as islands of their running maximum
end, and re-assembles the text with ``string_agg``.  A source CTE
named ``src`` must provide a unique key ``_k``, ``text`` and ``lang``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import names as NM
from ..operators import pii as PII
from .oracle_text import q

TAGS = list(P.DETECTORS)


def _group(tag: str) -> int:
    return 2 if tag in P.PREFIX_GROUP else 0


def spans_sql(tag: str, pattern: str | None = None, group: int | None = None,
              src: str = "src") -> str:
    """SELECT _k, tag, start, end, mention for one pattern (no context rule)."""
    p = q(pattern or P.detector_pattern(tag, "re2"))
    g = _group(tag) if group is None else group
    return f"""(
SELECT _k, {q(tag)} AS tag, CAST(pos - length(g) AS BIGINT) AS start, CAST(pos AS BIGINT) AS "end",
       g AS mention, text, lang
FROM (SELECT _k, text, lang, g,
             sum(length(gap) + length(m)) OVER (PARTITION BY _k ORDER BY i) AS pos
      FROM (SELECT _k, text, lang, unnest(m0) AS m, unnest(mg) AS g,
                   unnest(gs[1:len(m0)]) AS gap, unnest(range(len(m0))) AS i
            FROM (SELECT _k, text, lang, regexp_extract_all(text, {p}, 0) AS m0,
                         regexp_extract_all(text, {p}, {g}) AS mg,
                         string_split_regex(text, {p}) AS gs FROM {src}))))"""


def context_sql(tag: str, window: int = 20) -> str:
    """Boolean SQL: a context word near the span (columns text, lang, start, end)."""
    ctx = (f"lower(substr(text, greatest(start - {window}, 0) + 1, start - greatest(start - {window}, 0))"
           f" || ' ' || substr(text, \"end\" + 1, {window}))")
    def found(lg):
        p = PII.RULES.pattern(tag, lg)
        return f"regexp_matches({ctx}, {q(p)})" if p else "false"

    whens = " ".join(f"WHEN lang = {q(lg)} THEN {found(lg)}" for lg in PII.RULES.languages(tag))
    return f"(CASE {whens} ELSE {found(None)} END)" if whens else f"({found(None)})"


def type_sql(tag: str, window: int = 20, src: str = "src") -> str:
    body = spans_sql(tag, src=src)
    if tag in P.NEEDS_CONTEXT:
        body = f"(SELECT * FROM {body} WHERE {context_sql(tag, window)})"
    if tag in P.WITH_CONTEXT:
        weak = spans_sql(tag, P.weak_pattern(tag, "re2"), 0, src)
        body = f"(SELECT * FROM {body} UNION ALL SELECT * FROM {weak} WHERE {context_sql(tag, window)})"
    return body


def person_sql(src: str = "src") -> str:
    return (f"(SELECT * FROM {type_sql('PERSON', src=src)} UNION "
            f"SELECT * FROM {spans_sql('PERSON', P.name_list_pattern('re2'), 0, src)})")


def names_sql(names: str, max_words: int, src: str = "src") -> str:
    """SELECT _k, start, end, mention of names of the relation ``names`` (name, lang)."""
    grams = []
    for n in range(1, max_words + 1):
        ok = " AND ".join(f"lead(cap, {k}) OVER w AND lead(gap, {k}) OVER w = ' '" for k in range(1, n + 1))
        gram = " || ' ' || ".join(["m", *[f"lead(m, {k}) OVER w" for k in range(1, n)]])
        grams.append(f"SELECT _k, lang, start, {gram} AS gram, {gram} || ' ' || lead(m, {n}) OVER w AS mention, "
                     f"lead(stop, {n}) OVER w AS \"end\", {n} AS n, cap AND {ok} AS ok FROM placed "
                     f"WINDOW w AS (PARTITION BY _k ORDER BY i)")
    return f"""(
WITH parts AS (SELECT _k, lang, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS gap, unnest(range(len(ms))) AS i
               FROM (SELECT _k, lang, regexp_extract_all(text, {q(NM.WORD)}, 0) AS ms,
                            string_split_regex(text, {q(NM.WORD)}) AS gs FROM {src})),
placed AS (SELECT *, regexp_matches(m, {q(NM.CAPITAL)}) AS cap, CAST(stop - length(m) AS BIGINT) AS start
           FROM (SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY _k ORDER BY i) AS BIGINT) AS stop FROM parts)),
grams AS ({" UNION ALL ".join(grams)}),
met AS (SELECT g.*, row_number() OVER (PARTITION BY g._k, g.start ORDER BY n DESC) AS r
        FROM (SELECT DISTINCT g._k, g.start, g."end", g.mention, g.n FROM grams g JOIN {names} t
              ON t.name = g.gram AND (t.lang = '*' OR t.lang = g.lang) WHERE g.ok) g)
SELECT _k, start, "end", mention FROM met WHERE r = 1)"""


def candidates_sql(tags=P.DEFAULT_TAGS, window: int = 20, src: str = "src") -> str:
    parts = [type_sql(t, window, src) for t in tags if t in P.DETECTORS and t != "PERSON"]
    if "PERSON" in tags:
        parts.append(person_sql(src))
    return "(" + "\nUNION\n".join(f"SELECT _k, tag, start, \"end\", mention FROM {x}" for x in parts) + ")"


def _prio() -> str:
    return "CASE tag " + " ".join(f"WHEN {q(t)} THEN {v}" for t, v in P.TAG_PRIORITY.items()) + " ELSE 99 END"


def surrogate_sql(seed: int = 0) -> str:
    h = f"CAST(('0x' || substr(md5('{seed}:' || tag || ':' || mention), 1, 8)) AS BIGINT)"
    own = f"substr(md5('{seed}:' || tag || ':' || mention), 9, 12)"
    n_g, n_f = len(PII.SURROGATE_GIVEN), len(PII.SURROGATE_FAMILY)

    def one_of(names, div):
        return f"([{', '.join(q(n) for n in names)}])[({h} // {div}) % {len(names)} + 1]"

    def d(x, n):
        return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"
    return f"""(CASE tag
  WHEN 'EMAIL' THEN 'user' || {own} || '@example.com'
  WHEN 'IP_ADDRESS' THEN '10.' || CAST({h} % 256 AS VARCHAR) || '.' || CAST(({h} // 256) % 256 AS VARCHAR)
                         || '.' || CAST(({h} // 65536) % 256 AS VARCHAR)
  WHEN 'PHONE' THEN '555-' || {d(f'{h} % 1000', 3)} || '-' || {d(f'({h} // 1000) % 10000', 4)}
  WHEN 'KEY' THEN md5('{seed}:key:' || mention)
  WHEN 'ID' THEN {d(f'{h} % 1000000000', 9)}
  WHEN 'USER' THEN '@user' || {own}
  WHEN 'LICENSE_PLATE' THEN 'XY ' || {d(f'{h} % 10000', 4)}
  WHEN 'PERSON' THEN {one_of(PII.SURROGATE_GIVEN, 1)} || ' ' || {one_of(PII.INITIALS, n_g * n_f)} || '. ' || {one_of(PII.SURROGATE_FAMILY, n_g)}
  ELSE '[REDACTED]' END)"""


def anonymize_ctes(tags=P.DEFAULT_TAGS, window: int = 20, seed: int = 0) -> str:
    """CTEs after ``src``: cand, ranked, reached, islands, cover, kept, rep, anon(_k, text, n_mentions)."""
    return f"""
cand AS {candidates_sql(tags, window)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY _k ORDER BY start, "end" DESC, {_prio()}, mention) AS r
           FROM cand),
reached AS (SELECT *, max("end") OVER (PARTITION BY _k ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING) AS upto FROM ranked),
islands AS (SELECT *, sum(CASE WHEN upto IS NULL OR start >= upto THEN 1 ELSE 0 END)
                      OVER (PARTITION BY _k ORDER BY r) AS island FROM reached),
cover AS (SELECT _k, min(start) AS start, max("end") AS "end", arg_min(tag, {_prio()}) AS tag
          FROM islands GROUP BY _k, island),
kept AS (SELECT c._k, c.start, c."end", c.tag,
                substr(s.text, CAST(c.start + 1 AS BIGINT), CAST(c."end" - c.start AS BIGINT)) AS mention,
                CAST(row_number() OVER (PARTITION BY c._k ORDER BY c.start) - 1 AS BIGINT) AS idx
         FROM cover c JOIN (SELECT DISTINCT _k, text FROM src) s ON s._k = c._k),
sur AS (SELECT *, {surrogate_sql(seed)} AS sur FROM kept),
rep AS (SELECT *, coalesce(lag("end") OVER (PARTITION BY _k ORDER BY idx), 0) AS prev,
               CAST(start + coalesce(sum(length(sur) - length(mention)) OVER (PARTITION BY _k ORDER BY idx
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS new_start
        FROM sur),
anon AS (SELECT s._k,
                coalesce(string_agg(substr(s.text, CAST(r.prev + 1 AS BIGINT), CAST(r.start - r.prev AS BIGINT))
                                    || r.sur, '' ORDER BY r.idx), '')
                || substr(s.text, CAST(coalesce(max(r."end"), 0) + 1 AS BIGINT)) AS text,
                CAST(count(r.idx) AS BIGINT) AS n_mentions
         FROM src s LEFT JOIN rep r ON r._k = s._k GROUP BY s._k, s.text)"""


# A rule that gives every document a handle, a plate with its context word, two
# names, and mentions that overlap; the supplied texts hold none of these.
MARKED_SQL = ("text || ' by @reader_with_a_long_handle_name_' || doc_id || ', plate ABC ' || (doc_id % 9000 + 1000)"
              " || ' of Dr. Ana Silva; write Anna Smith@example.com or 1234567890123456789012' || doc_id || ' now'")


def marked_text(text, doc_id):
    """The Spark side of ``MARKED_SQL``."""
    n = F.col(doc_id)
    return F.concat(F.col(text), F.lit(" by @reader_with_a_long_handle_name_"), n.cast("string"), F.lit(", plate ABC "),
                    (n % 9000 + 1000).cast("string"), F.lit(" of Dr. Ana Silva; write Anna Smith@example.com or "
                                                            "1234567890123456789012"), n.cast("string"), F.lit(" now"))


def documents_src(cond: str | None = None, text: str = "text") -> str:
    return (f"src AS (SELECT doc_id AS _k, doc_id, {text} AS text, split_part(lang, '_', 1) AS lang"
            + (f", {cond} AS cond" if cond else "") + " FROM documents)")
