"""Detection rules held as rows (F3, F1d, F4), so that a language is more rows.

``context_words.csv`` has ``(lang, tag, word)``: words that speak for a mention of
that tag nearby; ``*`` applies to every language.  ``given_names.csv`` has ``(name,
lang)``.  Both are defaults; callers may pass rows or tables of their own.
"""

from __future__ import annotations

import csv
import io
import pkgutil
import re

from pyspark.sql import DataFrame, SparkSession

ANY = "*"
# Rules become one expression of the plan; larger tables are refused.
MAX_RULES = 5000


def _rows(name: str) -> list:
    text = pkgutil.get_data("corpusmill", f"data/{name}").decode("utf-8")
    return list(csv.DictReader(io.StringIO(text)))


CONTEXT_ROWS = tuple((r["lang"], r["tag"], r["word"]) for r in _rows("context_words.csv"))
NAME_ROWS = tuple((r["name"], r["lang"]) for r in _rows("given_names.csv"))


class ContextRules:
    """The words of ``(lang, tag, word)`` rows, per tag and language."""

    def __init__(self, rows=CONTEXT_ROWS):
        self.words: dict[str, dict[str, list]] = {}
        for lang, tag, word in sorted(set(map(tuple, rows))):
            self.words.setdefault(tag, {}).setdefault(lang, []).append(word.lower())

    @classmethod
    def of_table(cls, df: DataFrame) -> "ContextRules":
        """Rules of a table with columns ``lang, tag, word``."""
        rows = df.select("lang", "tag", "word").limit(MAX_RULES + 1).collect()
        if len(rows) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} context rules")
        return cls(rows)

    def languages(self, tag: str) -> list:
        return sorted(x for x in self.words.get(tag, {}) if x != ANY)

    def pattern(self, tag: str, lang: str | None = None) -> str | None:
        """Regex of the words of a tag in a language (and those of any), on lower-case
        text; None without words."""
        known = self.words.get(tag, {})
        words = known.get(ANY, []) + (known.get(lang, []) if lang else [])
        return "(^|[^a-z])(" + "|".join(map(re.escape, words)) + ")" if words else None


def names_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """``(name, lang)``: the packaged names, or those of a CSV file with that header."""
    if path is None:
        return spark.createDataFrame(list(NAME_ROWS), "name string, lang string")
    return spark.read.schema("name string, lang string").option("header", True).csv(path)
