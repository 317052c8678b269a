"""Person names by a name table (F4): token n-grams joined with their spans.

Capitalised words of a text, with their places, form runs (one space between
neighbours).  Every n-gram of a run up to the longest name of the table, followed by another
capitalised word, is a candidate; candidates keep their span and are joined to the table
on the n-gram.  The table is broadcast when its bytes were checked and found small;
a larger one is shuffled with the candidates, whose hot n-grams AQE splits.
Of names that start at one place the longest counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import spans as SP
from ..functions.arrays import explode_rows, let, scan_array
from ..functions.rules import ANY

# Words, and which of them are capitalised (letters only, so accented names too).
WORD = r"[\p{L}\p{N}_]+"
CAPITAL = r"^\p{Lu}\p{Ll}+$"
BROADCAST_BYTES = 64 << 20
TOKEN = "struct<start:bigint,end:bigint,text:string,run:int>"


def capital_tokens(text) -> Column:
    """array<struct<start, end, text, run>> of the capitalised words of a text."""
    t = F.col(text) if isinstance(text, str) else text
    items = F.arrays_zip(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("m"), F.split(t, WORD, -1).alias("gap"))
    none = F.array().cast(f"array<{TOKEN}>")

    def step(st, x):
        start = st["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        capital = F.coalesce(x["m"].rlike(CAPITAL), F.lit(False))
        run = F.when(st["capital"] & (x["gap"] == " "), st["run"]).otherwise(st["run"] + 1)
        token = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), x["m"].alias("text"), run.alias("run"))
        return (F.struct(end.alias("at"), run.alias("run"), capital.alias("capital")),
                F.when(capital, F.array(token)).otherwise(none))

    first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("run"), F.lit(False).alias("capital"))
    return scan_array(items, first, step, TOKEN)


def name_candidates(text, max_words: int) -> Column:
    """array<struct<start, end, gram, text, words>>: n-grams with the word after them."""
    def grams(a, n):
        def at(i, k):
            return F.get(a, i + k)

        def one(x, i):
            gram = F.concat_ws(" ", *[at(i, k)["text"] for k in range(n)])
            nxt = at(i, F.lit(n))
            return F.when(nxt["run"] == x["run"], F.struct(
                x["start"].alias("start"), nxt["end"].alias("end"), gram.alias("gram"),
                F.concat_ws(" ", gram, nxt["text"]).alias("text"), F.lit(n).alias("words")))

        return F.transform(a, one)

    return let(capital_tokens(text), lambda a: F.filter(
        F.concat(*[grams(a, n) for n in range(1, max_words + 1)]), lambda x: x.isNotNull()))


def detect_names(df: DataFrame, id_cols: list[str], names: DataFrame, text_col: str = "text",
                 lang_col: str | None = None) -> DataFrame:
    """``(ids..., start, end, mention)`` of names of the table ``names (name, lang)``.

    With ``lang_col`` (a base language) a name counts in its own language and, for
    ``*``, in all.
    """
    table = names.where(F.col("name").isNotNull()).select("name", F.coalesce("lang", F.lit(ANY)).alias("_lang")).distinct()
    size, words = table.agg(F.sum(F.octet_length("name") + 24),
                            F.max(F.size(F.split("name", " ")))).first()
    keep = [*id_cols, *([F.col(lang_col).alias("_own")] if lang_col else [])]
    cands = explode_rows(df, keep, name_candidates(text_col, int(words or 1)), "c")
    cands = cands.select(*id_cols, *(["_own"] if lang_col else []), "c.*")
    if (size or 0) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    met = cands.join(table, F.col("gram") == F.col("name"))
    if lang_col:
        met = met.where((F.col("_lang") == ANY) | (F.col("_lang") == F.col("_own")))
    longest = Window.partitionBy(*id_cols, "start").orderBy(F.desc("words"))
    return (met.select(*id_cols, "start", "end", F.col("text").alias("mention"), "words").distinct()
            .withColumn("_r", F.row_number().over(longest)).where("_r = 1")
            .select(*id_cols, "start", "end", "mention"))


def with_name_spans(df: DataFrame, names: DataFrame, text_col: str = "text", lang_col: str | None = None,
                    out_col: str = "name_spans") -> DataFrame:
    """``df`` with the names of each row as an array of PERSON spans, for ``pii.detect``
    (``more_spans``).  ``df`` is read twice and must number its rows alike: pass a stored table
    with a unique ``_row`` column."""
    found = detect_names(df, ["_row"], names, text_col, lang_col)
    span = F.struct("start", "end", F.col("mention").alias("text"), F.lit("PERSON").alias("tag"))
    spans = found.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias(out_col))
    none = F.array().cast(f"array<{SP.SPAN_TYPE}>")
    return df.join(spans, "_row", "left").withColumn(out_col, F.coalesce(out_col, none))
