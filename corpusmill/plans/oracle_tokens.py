"""DuckDB SQL for vocabulary, segmentation and alignment checks.

CTE builders: ``sent`` (kept sentences), ``vocab`` (the rule vocabulary)
and ``seg(word, ids, toks)`` (greedy longest match by a recursive walk).
"""

from __future__ import annotations

from ..functions import patterns as P
from ..operators.vocab import CHAR, CONT, SPECIALS, UNK_ID
from .oracle_text import kept_sentences, q

WORD = q(P.WORD)


def sent_cte() -> str:
    return f"""sent0 AS (SELECT doc_id AS article_id, {kept_sentences('text', 5, 200)} AS sents FROM documents),
sent AS (SELECT article_id, CAST(generate_subscripts(sents, 1) - 1 AS BIGINT) AS sent_idx,
                unnest(sents) AS text FROM sent0)"""


def vocab_ctes(top_words: int = 500, src: str = "sent") -> str:
    specials = ", ".join(f"({q(t)}, 0, {i})" for i, t in enumerate(SPECIALS))
    return f"""wc AS (SELECT w AS word, count(*) AS n
       FROM (SELECT unnest(regexp_extract_all(text, {WORD}, 0)) AS w FROM {src}) GROUP BY w),
ch AS (SELECT DISTINCT unnest(regexp_extract_all(word, {q(CHAR)}, 0)) AS c FROM wc),
v0 AS (SELECT * FROM (VALUES {specials}) t(token, grp, k)
       UNION ALL SELECT c, 1, 0 FROM ch
       UNION ALL SELECT '{CONT}' || c, 2, 0 FROM ch
       UNION ALL SELECT * FROM (SELECT word, 3, -n FROM wc WHERE length(word) > 1
                                ORDER BY n DESC, word LIMIT {top_words})),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY grp, k, token) - 1 AS INTEGER) AS id FROM v0)"""


def seg_ctes(words_src: str) -> str:
    """``words_src`` is a relation with a ``word`` column (duplicates allowed)."""
    return f"""wds AS (SELECT DISTINCT word FROM {words_src}),
wch AS (SELECT word, regexp_extract_all(word, {q(CHAR)}, 0) AS chars FROM wds),
lmax AS (SELECT max(length(regexp_replace(token, '^##', ''))) AS lm FROM vocab),
c1 AS (SELECT word, chars, unnest(range(len(chars))) AS i FROM wch
       WHERE len(chars) >= 1),
c2 AS (SELECT word, chars, i, unnest(range(1, least((SELECT lm FROM lmax), len(chars) - i) + 1)) AS l FROM c1),
cand AS (SELECT word, i, l, (CASE WHEN i > 0 THEN '{CONT}' ELSE '' END)
                || array_to_string(chars[i + 1:i + l], '') AS token FROM c2),
best AS (SELECT c.word, c.i, max(c.l) AS l, arg_max(v.id, c.l) AS id, arg_max(v.token, c.l) AS tok
         FROM cand c JOIN vocab v ON v.token = c.token GROUP BY c.word, c.i),
walk AS (SELECT word, 0 AS pos, 0 AS k, CAST(NULL AS INTEGER) AS id, CAST(NULL AS VARCHAR) AS tok
         FROM wch WHERE len(chars) >= 1
         UNION ALL
         SELECT w.word, w.pos + b.l, w.k + 1, b.id, b.tok
         FROM walk w JOIN best b ON b.word = w.word AND b.i = w.pos),
reach AS (SELECT word, max(pos) AS r FROM walk GROUP BY word),
pieces AS (SELECT word, list(id ORDER BY k) AS ids, list(tok ORDER BY k) AS toks FROM walk WHERE k > 0
           GROUP BY word),
seg AS (SELECT x.word,
               CASE WHEN reach.r = len(x.chars) THEN pieces.ids ELSE [{UNK_ID}] END AS ids,
               CASE WHEN reach.r = len(x.chars) THEN pieces.toks ELSE ['{SPECIALS[UNK_ID]}'] END AS toks
        FROM wch x LEFT JOIN reach ON reach.word = x.word LEFT JOIN pieces ON pieces.word = x.word)"""


def ints(x: str) -> str:
    """list<int> -> space-separated string ('null' for NULL)."""
    return f"array_to_string(list_transform({x}, lambda e: coalesce(CAST(e AS VARCHAR), 'null')), ' ')"


def pad_cut(v: str, length: int, pad: str) -> str:
    return (f"(CASE WHEN len({v}) < {length} THEN list_concat({v}, list_transform(range({length} - len({v})), "
            f"lambda e: {pad})) ELSE {v}[1:{length}] END)")


def text_of(toks: str) -> str:
    specials = "[" + ", ".join(q(s) for s in SPECIALS) + "]"
    return (f"replace(array_to_string(list_filter({toks}, lambda t: NOT list_contains({specials}, t)), ' '), "
            f"' {CONT}', '')")
