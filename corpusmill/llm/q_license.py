"""Checked query: license scans."""

from __future__ import annotations

from corpusmill.llm import licenses as L
from corpusmill.llm.common import read
from corpusmill.llm.license_rules import rules
from corpusmill.llm.registry import register


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _words(t: str) -> str:
    return f"((length({t}) - length(replace({t}, ' ', ''))) // 2)"


def _base(phrase: str, label: str) -> str:
    p, k = L.spaced(phrase), phrase.count(" ") + 1
    return (f"SELECT rid, len(g) - 1 AS n, {_words('g[1]')} AS first, {_words('t')} - {_words('g[-1]')} - {k} AS last,"
            f" {_q(label)} AS label FROM (SELECT rid, t, string_split(t, {_q(p)}) AS g FROM w WHERE contains(t, {_q(p)}))")


_TABLE = ", ".join(f"({n}, {_q(label)}, {tier}, {_q(' ' + keyword + ' ')}, {_q(regex)})"
                   for n, label, tier, keyword, regex in rules())
_TIERS = ", ".join(f"max(CASE WHEN tier <= {t} THEN stop END) OVER before AS to{t}" for t in L.SCORES)

SQL12 = f"""
WITH low AS (SELECT row_number() OVER () AS rid, doc_id,
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT rid, doc_id, CASE WHEN regexp_matches(t, '{L.LETTER}')
             THEN regexp_replace(t, '{L.SEPARATOR}*({L.LETTER}+){L.SEPARATOR}*', ' \\1 ', 'g') ELSE '' END AS t FROM low),
base AS ({" UNION ALL ".join(_base(p, x) for p, x in L.PHRASES.items())}),
b AS (SELECT rid, sum(n) AS n, min(first) AS first, max(last) AS last, list(DISTINCT label) AS labels FROM base GROUP BY 1),
rules AS (SELECT * FROM (VALUES {_TABLE}) r(rule, label, tier, keyword, regex)),
hit AS (SELECT rid, rule, label, tier, regexp_extract_all(t, regex, 0) AS m, string_split_regex(t, regex) AS g
        FROM w JOIN rules ON contains(t, keyword) WHERE regexp_matches(t, regex)),
part AS (SELECT rid, rule, label, tier, unnest(m) AS m, unnest(g[1:len(m)]) AS g, unnest(range(len(m))) AS i FROM hit),
span AS (SELECT rid, rule, label, tier, stop - length(m) AS start, stop FROM
         (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY rid, rule ORDER BY i) AS stop FROM part)),
reach AS (SELECT *, {_TIERS} FROM span
          WINDOW before AS (PARTITION BY rid ORDER BY start, stop DESC, tier, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lasting AS (SELECT rid, min(tier) AS tier, list(DISTINCT label) AS labels FROM reach
            WHERE coalesce(CASE tier {" ".join(f"WHEN {t} THEN to{t}" for t in L.SCORES)} END, -1) < stop GROUP BY 1)
SELECT doc_id, CAST({_words('w.t')} AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(b.first AS BIGINT) AS first_word, CAST(b.last AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, lasting.labels))), ','), '') AS labels,
       CAST(CASE least(lasting.tier, CASE WHEN b.n > 0 THEN {L.BASE_TIER} END)
            {" ".join(f"WHEN {t} THEN {v}" for t, v in L.SCORES.items())} ELSE 0 END AS DOUBLE) AS score
FROM w LEFT JOIN b ON b.rid = w.rid LEFT JOIN lasting ON lasting.rid = w.rid
"""


@register("op12_licenses", SQL12)
def op12(spark, sf_dir):
    return L.detect_licenses(read(spark, sf_dir, "documents", "doc_id", "text"))
