"""Column expressions for text cleaning and sentence extraction (no UDFs).

All functions take and return ``Column``s, so Catalyst keeps them inside
whole-stage code generation (the higher-order ``transform`` is evaluated
JVM-side per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

# ---------------------------------------------------------------------------
# Latin transliteration (T2, ours; Latin letters only)
# ---------------------------------------------------------------------------
TRANSLIT_MULTI = (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"),
                  ("þ", "th"), ("Þ", "Th"))


def _latin_table() -> tuple[str, str]:
    """Letters U+00C0-U+024F whose NFKD form starts with one ASCII letter."""
    import unicodedata
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        ch = chr(cp)
        base = unicodedata.normalize("NFKD", ch)[:1]
        if ch.isalpha() and base.isascii() and base.isalpha() and base != ch:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


# Letters with a stroke have no decomposition; fixed values:
TRANSLIT_STROKE = (("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"), ("đ", "d"), ("Đ", "D"),
                   ("ð", "d"), ("Ð", "D"), ("ħ", "h"), ("Ħ", "H"))

TRANSLIT_FROM = _latin_table()[0] + "".join(x for x, _ in TRANSLIT_STROKE)
TRANSLIT_TO = _latin_table()[1] + "".join(y for _, y in TRANSLIT_STROKE)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_strip(text) -> Column:
    """Drop every code point outside ASCII."""
    return F.regexp_replace(_col(text), P.NON_ASCII, "")


def transliterate(text) -> Column:
    """Map common Latin letters with marks to ASCII before the strip."""
    c = _col(text)
    for a, b in TRANSLIT_MULTI:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, TRANSLIT_FROM, TRANSLIT_TO)


def collapse_spaces(text) -> Column:
    """Collapse runs of two or more U+0020 into one (tabs stay)."""
    return F.regexp_replace(_col(text), P.MULTI_SPACE, " ")


def clean_ascii(text, use_transliteration: bool = False) -> Column:
    """T1 (+T2) then T3, in the order the reference applies them."""
    c = _col(text)
    if use_transliteration:
        c = transliterate(c)
    return collapse_spaces(ascii_strip(c))


def extract_lines(text) -> Column:
    """T4: array of trimmed pieces between newlines and pipes, 3+ chars."""
    return F.regexp_extract_all(_col(text), F.lit(P.LINE), 1)


def _marked_split(line, abbreviations, dot: str) -> Column:
    at_dot = P.abbreviation_dot(abbreviations)
    if at_dot is not None:
        c = F.regexp_replace(line, at_dot, dot)
    else:
        c = F.regexp_replace(line, P.abbreviation_pattern(abbreviations), "$1$2" + dot)
    return F.regexp_replace(c, P.SENT_END, "$1" + P.END_MARK + "$2")


def split_sentences(line, abbreviations=P.ABBREVIATIONS) -> Column:
    """T5: rule-based sentence split of one line -> array<string>.

    The two marks used on the way may themselves occur in a line; such lines
    write them as escapes (mark 2 and a letter) first and get them back.
    """
    c = _col(line)
    # A literal search: ``translate`` would look up every character.
    plain = F.split(F.replace(_marked_split(c, abbreviations, P.ABBR_MARK), F.lit(P.ABBR_MARK), F.lit(".")), P.END_MARK)
    esc = P.ABBR_MARK
    safe = F.replace(F.replace(c, F.lit(esc), F.lit(esc + "b")), F.lit(P.END_MARK), F.lit(esc + "a"))

    def restored(x):
        for code, char in (("c", "."), ("a", P.END_MARK), ("b", esc)):
            x = F.replace(x, F.lit(esc + code), F.lit(char))
        return x

    escaped = F.transform(F.split(_marked_split(safe, abbreviations, esc + "c"), P.END_MARK), restored)
    return F.when(c.contains(P.END_MARK) | c.contains(P.ABBR_MARK), escaped).otherwise(plain)


def extract_sentences(text, use_transliteration: bool = False,
                      abbreviations=P.ABBREVIATIONS) -> Column:
    """T7 = T1 -> T3 -> T4 -> T5 -> T6 as one expression."""
    lines = extract_lines(clean_ascii(text, use_transliteration))
    return F.flatten(F.transform(lines, lambda l: split_sentences(l, abbreviations)))


def count_spaces(text) -> Column:
    """Number of U+0020 characters (the reference's ``s.count(" ")``)."""
    c = _col(text)
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def spaces_between(text, min_spaces: int | None = 5, max_spaces: int | None = 200) -> Column:
    """Inclusive bounds on the space count; ``None`` drops that bound."""
    n = count_spaces(text)
    cond = F.lit(True)
    if min_spaces is not None:
        cond = cond & (n >= F.lit(min_spaces))
    if max_spaces is not None:
        cond = cond & (n <= F.lit(max_spaces))
    return cond


def keep_sentences(sentences, min_spaces: int | None = 5, max_spaces: int | None = 200) -> Column:
    """P4 applied inside the array, so an article keeps its row."""
    return F.filter(_col(sentences), lambda s: spaces_between(s, min_spaces, max_spaces))


def lang_base(lang) -> Column:
    """Language code before the first underscore (``en_US`` -> ``en``)."""
    return F.substring_index(_col(lang), "_", 1)


def text_bytes(sentences) -> Column:
    """Total characters of an array of ASCII sentences (= bytes)."""
    return F.aggregate(_col(sentences), F.lit(0).cast("bigint"),
                       lambda acc, s: acc + F.length(s).cast("bigint"))
