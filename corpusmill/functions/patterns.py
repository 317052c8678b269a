"""Regular expressions shared by the Spark code and the DuckDB oracle.

Spark runs Java regex, DuckDB runs RE2.  Every pattern here avoids
back-references and avoids look-around on the RE2 side, and spells out its
whitespace class, because ``\\s`` differs between the engines.  Where Java needs
a different spelling (word boundaries: Java 17's ``\\b`` is Unicode-aware,
RE2's is ASCII) both spellings live next to each other.
"""

from __future__ import annotations

import re
import string

from .rules import NAME_ROWS

# ---------------------------------------------------------------------------
# Sentence extraction
# ---------------------------------------------------------------------------
# ASCII whitespace as Python's ``\s`` sees it after the ASCII strip:
# \t \n \x0b \x0c \r, \x1c-\x1f and the space.
WS = r"\t-\r\x1c-\x20"

NON_ASCII = r"[^\x00-\x7F]"
MULTI_SPACE = r" [ ]+"
# A line: starts and ends with a non-space, non-pipe character, at least 3
# characters, never crosses a newline or a pipe.
LINE = rf"([^|{WS}][^|\n]+[^|{WS}])"

# Abbreviations whose period does not end a sentence (a parameter of
# ``split_sentences``; this is the default list).
ABBREVIATIONS = ("[A-Za-z]", "Dr", "Mr", "Mrs", "Ms", "St", "vs", "etc", "No")

# Sentence end: . ! or ? with up to two closing quotes/brackets, then
# whitespace, then a character that is not a lower-case letter.
SENT_END = r"""([.!?]["')\]]{0,2})[\t-\r ]+([^a-z\t-\r ])"""

# Markers used while splitting (never present after the ASCII strip of
# printable text; \x01/\x02 are removed from the text first).
END_MARK = "\x01"
ABBR_MARK = "\x02"


def abbreviation_pattern(abbreviations=ABBREVIATIONS) -> str:
    return r"(^|[ (])(" + "|".join(abbreviations) + r")\."


def abbreviation_dot(abbreviations=ABBREVIATIONS) -> str | None:
    """The period alone of the same places (Java: looks back from each period, which is
    found faster than each possible start), or None where an abbreviation has no fixed length."""
    if not all(re.fullmatch(r"(?:[A-Za-z0-9]|\[[A-Za-z0-9-]+\])+", a) for a in abbreviations):
        return None
    return r"\.(?<=(?:^|[ (])(?:" + "|".join(abbreviations) + r")\.)"


# ---------------------------------------------------------------------------
# Word rule for vocabulary and encoding
# ---------------------------------------------------------------------------
# One punctuation character, or a run of characters that are neither
# whitespace nor punctuation.
PUNCT = r"!-/:-@\[-`{-~\p{P}"
WORD = rf"[{PUNCT}]|[^{WS}{PUNCT}]+"
# The same words of an ASCII text: single characters make a bit set in Java, ranges are tested one by one.
_MARKS = "".join("\\" + chr(c) for a, b in (("!", "/"), (":", "@"), ("[", "`"), ("{", "~")) for c in range(ord(a), ord(b) + 1))
_SPACES = "".join(rf"\x{c:02x}" for c in (*range(9, 14), *range(28, 33)))
ASCII_WORD = rf"[^{_SPACES}{_MARKS}]++|[{_MARKS}]"

# ---------------------------------------------------------------------------
# Personal-data detectors
# ---------------------------------------------------------------------------
# Word boundary tokens, replaced per dialect by ``detector_pattern``.
_BS = "<B>"   # boundary before a word character
_BE = "<E>"   # boundary after a word character
_JAVA_B = {_BS: r"(?<![A-Za-z0-9_])", _BE: r"(?![A-Za-z0-9_])"}
_RE2_B = {_BS: r"\b", _BE: r"\b"}

DETECTORS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "IP_ADDRESS": r"<B>(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
                  r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])<E>",
    "PHONE": r"(?:\+[0-9]{1,3}[ -])?(?:\([0-9]{3}\) |[0-9]{3}-)[0-9]{3}-[0-9]{4}<E>",
    "KEY": r"<B>[A-Fa-f0-9]{32,}<E>",
    "ID": r"<B>[0-9]{9,}<E>",
    # group 1 is a consumed prefix; the mention is group 2
    "USER": r"(^|[ (])(@[A-Za-z0-9_]{2,})<E>",
    "LICENSE_PLATE": r"<B>[A-Z]{1,3}[ -][0-9]{1,4}<E>",
    # group 1 is the honorific; the mention (the name) is group 2
    "PERSON": r"<B>((?:Dr|Mr|Mrs|Ms|Prof|Sr|Sra|Mme|Herr|Frau)\.? )"
              r"([A-Z][a-z]+(?: [A-Z][a-z]+)*)<E>",
}

# Detectors whose mention is a capture group after a consumed prefix.
PREFIX_GROUP = {"USER", "PERSON"}

# Default tag set (all eight types).
DEFAULT_TAGS = ("IP_ADDRESS", "KEY", "ID", "PHONE", "USER", "EMAIL", "LICENSE_PLATE", "PERSON")

# Priority when two mentions start at the same place and have equal length.
TAG_PRIORITY = {t: i for i, t in enumerate(
    ("EMAIL", "KEY", "IP_ADDRESS", "PHONE", "ID", "USER", "LICENSE_PLATE", "PERSON"))}

# Tags whose mentions need a context word nearby (``rules``), and weaker patterns that
# count as their tag only with one.
NEEDS_CONTEXT = {"LICENSE_PLATE"}
WITH_CONTEXT = {"KEY": r"<B>[A-Fa-f0-9]{16,31}<E>"}

# The same mentions, spelled so that Java rejects most places of a text by one bit set (single characters
# make one, ranges are tested one by one) before it looks around.  All of them are group 0 but PERSON.
_UPPER, _LOWER, _DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
_LOCAL = f"[{_UPPER}{_LOWER}{_DIGITS}._%+-]"
_HEX = f"[ABCDEFabcdef{_DIGITS}]"
JAVA_DETECTORS = {
    # From the @ on; the run of ``JAVA_BEFORE`` in front of it, back to the match before, belongs to the mention.
    "EMAIL": rf"(?!\G)@(?<={_LOCAL}@)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}",
    "IP_ADDRESS": rf"(?=[{_DIGITS}])" + DETECTORS["IP_ADDRESS"],
    "PHONE": rf"(?=[+({_DIGITS}])" + DETECTORS["PHONE"],
    "KEY": rf"{_HEX}(?<![A-Za-z0-9_]{_HEX}){_HEX}{{31,}}+<E>",
    "ID": rf"[{_DIGITS}](?<![A-Za-z0-9_][0-9])[0-9]{{8,}}+<E>",
    "USER": r"@(?<=(?:^|[ (])@)[A-Za-z0-9_]{2,}+",
    "LICENSE_PLATE": rf"(?=[{_UPPER}])<B>[A-Z]{{1,3}}+[ -][0-9]{{1,4}}+<E>",
    "PERSON": r"(?=[DMPSHF])" + DETECTORS["PERSON"],
}
JAVA_GROUP = {"PERSON": 2}
JAVA_BEFORE = {"EMAIL": _LOCAL}
# Tag -> pattern of its strong and weak mentions, and how long the strong ones are at least.
JAVA_EITHER = {"KEY": (JAVA_DETECTORS["KEY"].replace("{31,}", "{15,}"), 32)}

# What every mention of a tag holds, as parts of one quick search: a text without any of them has no mention.  Single
# characters again, and the given names of ``GIVEN_NAMES`` with those of PERSON.
_DIGIT, _CAPITAL = f"[{_DIGITS}]", f"[{_UPPER}]"
HELD_BY = {
    "IP_ADDRESS": rf"{_DIGIT}\.{_DIGIT}",
    "PHONE": rf"{_DIGIT}{{3}}-{_DIGIT}{{4}}",
    "ID": rf"{_DIGIT}{{9}}",
    "LICENSE_PLATE": rf"{_CAPITAL}[ -]{_DIGIT}",
    "PERSON": rf"(?:Dr|Mr|Mrs|Ms|Prof|Sr|Sra|Mme|Herr|Frau)\.? {_CAPITAL}[a-z]",
}
HELD_RUN = {"KEY": f"{_HEX}{{16}}"}
HELD_TEXT = {"EMAIL": "@", "USER": "@"}

# Given names of the name-list detector (``Name Surname``): the first words of the packaged
# table that hold in every language.
GIVEN_NAMES = tuple(name for name, lang in NAME_ROWS if lang == "*")


def _spelled(p: str, dialect: str) -> str:
    for k, v in (_JAVA_B if dialect == "java" else _RE2_B).items():
        p = p.replace(k, v)
    return p


def detector_pattern(tag: str, dialect: str = "java") -> str:
    return _spelled((JAVA_DETECTORS if dialect == "java" else DETECTORS)[tag], dialect)


def detector_group(tag: str, dialect: str = "java") -> int:
    """The group of ``detector_pattern`` that is the mention."""
    return JAVA_GROUP.get(tag, 0) if dialect == "java" else 2 if tag in PREFIX_GROUP else 0


def either_pattern(tag: str) -> tuple | None:
    """(Java pattern, length): mentions with and without need of a context word in one pass, and from
    which length on they need none."""
    if tag not in JAVA_EITHER:
        return None
    pattern, strong = JAVA_EITHER[tag]
    return _spelled(pattern, "java"), strong


def weak_pattern(tag: str, dialect: str = "java") -> str:
    return _spelled(WITH_CONTEXT[tag], dialect)


def name_list_pattern(dialect: str = "java") -> str:
    first = "".join(sorted({name[0] for name in GIVEN_NAMES}))
    return _spelled((f"(?=[{first}])" if dialect == "java" else "") + "<B>((?:" + "|".join(GIVEN_NAMES) + r") [A-Z][a-z]+)<E>", dialect)


def held_pattern(tags) -> str | None:
    """One Java pattern that is found in every text with a mention of ``tags``, but those of ``HELD_RUN`` and ``HELD_TEXT``."""
    parts = [HELD_BY[tag] for tag in HELD_BY if tag in tags]
    if "PERSON" in tags:
        parts.append("(?:" + "|".join(GIVEN_NAMES) + rf") {_CAPITAL}[a-z]")
    first = (_DIGITS if {"IP_ADDRESS", "PHONE", "ID"} & set(tags) else "") + _UPPER
    return f"(?=[{first}])(?:" + "|".join(parts) + ")" if parts else None
