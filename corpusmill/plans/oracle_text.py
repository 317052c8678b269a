"""DuckDB SQL fragments for the text rules, built from the shared patterns."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions import text as T


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ascii_strip(x: str) -> str:
    return f"regexp_replace({x}, {q(P.NON_ASCII)}, '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, {q(P.MULTI_SPACE)}, ' ', 'g')"


def transliterate(x: str) -> str:
    for a, b in T.TRANSLIT_MULTI:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return f"translate({x}, {q(T.TRANSLIT_FROM)}, {q(T.TRANSLIT_TO)})"


def clean(x: str, translit: bool = False) -> str:
    return collapse(ascii_strip(transliterate(x) if translit else x))


def lines(x: str) -> str:
    return f"regexp_extract_all({x}, {q(P.LINE)}, 1)"


def split_sentences(line: str) -> str:
    c = f"translate({line}, {q(P.END_MARK + P.ABBR_MARK)}, '')"
    c = f"regexp_replace({c}, {q(P.abbreviation_pattern())}, {q(chr(92) + '1' + chr(92) + '2' + P.ABBR_MARK)}, 'g')"
    c = f"regexp_replace({c}, {q(P.SENT_END)}, {q(chr(92) + '1' + P.END_MARK + chr(92) + '2')}, 'g')"
    c = f"translate({c}, {q(P.ABBR_MARK)}, '.')"
    return f"string_split({c}, {q(P.END_MARK)})"


def sentences(x: str, translit: bool = False) -> str:
    return f"flatten(list_transform({lines(clean(x, translit))}, lambda l: {split_sentences('l')}))"


def n_spaces(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')))"


def keep(arr: str, lo: int | None = 5, hi: int | None = 200) -> str:
    conds = []
    if lo is not None:
        conds.append(f"{n_spaces('s')} >= {lo}")
    if hi is not None:
        conds.append(f"{n_spaces('s')} <= {hi}")
    if not conds:
        return arr
    return f"list_filter({arr}, lambda s: {' AND '.join(conds)})"


def kept_sentences(x: str, lo: int | None = 5, hi: int | None = 200) -> str:
    return keep(sentences(x), lo, hi)


def list_bytes(arr: str) -> str:
    return f"CAST(coalesce(list_sum(list_transform({arr}, lambda s: length(s))), 0) AS BIGINT)"
