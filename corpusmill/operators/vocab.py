"""Subword vocabulary (K1), its table form, save/load.

Training works on *distinct words with counts*, never on occurrences: the
word count is one aggregate with map-side combine, so a hot word costs one
row per task before the shuffle.  ``train_vocab`` merges exactly as one pair at a
time would (``bpe``).  With ``merges_per_round`` it takes many merges
from one pair count instead, fewer rounds for a vocabulary that differs a little:
merges chosen in one round are applied in one pass with the same result
as applying them one by one (see ``choose_merges``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.arrays import explode_rows
from ..functions.words import ascii_text, count_words, is_ascii, other_words, split_words  # noqa: F401
from ..sources.staging import stage
from .bpe import CONT, coded_merges, coded_name, coded_words, merged_token, symbol_counts

# Special tokens and their ids (BERT order).
SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
PAD_ID, UNK_ID, CLS_ID, SEP_ID, MASK_ID = range(5)
CHAR = "(?s)."


def words(text) -> Column:
    """Pre-tokenization: punctuation characters and runs of other non-space."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(is_ascii(t), F.regexp_extract_all(t, F.lit(P.ASCII_WORD), 0)).otherwise(
        F.regexp_extract_all(t, F.lit(P.WORD), 0))


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)`` over all rows (counted per task first)."""
    t = F.col(text_col)
    return (df.select(ascii_text(t).alias("text"), other_words(t).alias("others"))
            .mapInArrow(count_words, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def initial_symbols(word) -> Column:
    """Characters of a word; all but the first carry the ``##`` prefix."""
    chars = F.regexp_extract_all(F.col(word) if isinstance(word, str) else word, F.lit(CHAR), 0)
    return F.transform(chars, lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit(CONT), c)))


def pair_counts(wc: DataFrame, symbols_col: str = "syms") -> DataFrame:
    """``(left, right, n)``: adjacent symbol pairs weighted by word count."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(symbols_col) - 1, F.lit(1))),
                        lambda i: F.struct(F.element_at(symbols_col, i).alias("left"),
                                           F.element_at(symbols_col, i + 1).alias("right")))
    return (wc.where(F.size(symbols_col) > 1)
            .select("n", F.explode(pairs).alias("p"))
            .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right"))
            .agg(F.sum("n").cast("bigint").alias("n")))


def apply_merges(symbols: Column, merges: dict[tuple[str, str], str]) -> Column:
    """One left-to-right pass merging chosen adjacent pairs.

    The merged token follows from the pair (``merged_token``), so the pass
    only tests membership; an ``IN`` over many literals is planned as a hash
    set (InSet), so a round costs O(1) per symbol whatever its merge count.
    """
    if not merges:
        return symbols
    keys = [a + "\x00" + b for (a, b) in merges]
    init = F.struct(F.array().cast("array<string>").alias("out"),
                    F.lit(None).cast("string").alias("prev"))

    def step(acc, x):
        hit = F.concat(acc["prev"], F.lit("\x00"), x).isin(keys)
        merged = F.concat(acc["prev"], F.when(x.startswith(CONT), F.substring(x, len(CONT) + 1, 1 << 30))
                          .otherwise(x))
        return (F.when(acc["prev"].isNull(), F.struct(acc["out"].alias("out"), x.alias("prev")))
                .when(hit, F.struct(F.concat(acc["out"], F.array(merged)).alias("out"),
                                    F.lit(None).cast("string").alias("prev")))
                .otherwise(F.struct(F.concat(acc["out"], F.array(acc["prev"])).alias("out"),
                                    x.alias("prev"))))

    return F.aggregate(symbols, init, step, lambda acc: F.when(
        acc["prev"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["prev"]))))


def choose_merges(cands: list, m: int, taken: set) -> list[tuple[str, str, int]]:
    """Greedy choice from candidates sorted by priority (count desc).

    One left-to-right pass applies the chosen pairs exactly as sequential
    application in priority order would, unless a lower-ranked pair ends on
    the left symbol of a higher-ranked one (``w x`` before ``x y`` in
    ``w x y``).  Such pairs, and pairs whose merged token exists, wait for a
    later round, where their counts are recomputed.
    """
    lefts, out = set(), []
    for left, right, n in cands:
        if len(out) >= m:
            break
        tok = merged_token(left, right)
        if right in lefts or tok in taken:
            continue
        lefts.add(left)
        out.append((left, right, n))
        taken.add(tok)
    return out


def train_vocab(df: DataFrame, text_col: str = "text", vocab_size: int = 20000,
                merges_per_round: int | None = None, min_pair_count: int = 2,
                checkpoint_every: int = 5, max_rounds: int | None = None,
                growth: float = 0.25) -> DataFrame:
    """K1: ``(token, id, kind)`` with specials, alphabet, then merges in order.

    By default the merges are those of sequential training.  With
    ``merges_per_round`` a round takes up to ``max(merges_per_round, growth *
    current size)`` merges from one pair count, so the number of rounds grows with
    the log of ``vocab_size``.

    ``kind`` is ``special`` / ``char`` / ``merge``.  The alphabet is every
    character of the train words (initial and ``##`` forms).
    """
    from ..session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    # Every core works in every round, whatever the partitions of the counts.
    par = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wc = word_counts(df, text_col).repartition(par, "word")
    if merges_per_round is None:
        wc = stage(coded_words(wc), "words")
        counts = symbol_counts(wc).collect()
        names = {r.code: coded_name(r.code) for r in counts}
        used = [(names[r.code], r.n) for r in counts]
    else:
        wc = wc.select(initial_symbols("word").alias("syms"), "n").checkpoint()
        used = [tuple(r) for r in wc.select(F.explode("syms").alias("s"), "n").groupBy("s").agg(F.sum("n").alias("n")).collect()]
    # Where even the alphabet is too large, its most frequent characters stay.
    room = max(0, vocab_size - len(SPECIALS))
    alphabet = sorted(c for c, _ in sorted(used, key=lambda r: (-r[1], r[0]))[:room])
    # alphabet is bounded by the character set, not by the data size
    vocab = list(SPECIALS) + sorted(a for a in alphabet if not a.startswith(CONT)) \
        + sorted(a for a in alphabet if a.startswith(CONT))
    kinds = ["special"] * len(SPECIALS) + ["char"] * (len(vocab) - len(SPECIALS))
    taken = set(vocab)
    if merges_per_round is None:
        merges = coded_merges(wc, names, vocab_size - len(vocab), taken, min_pair_count)
        vocab += [merged_token(a, b) for a, b in merges]
        kinds += ["merge"] * len(merges)
        return _vocab_table(spark, vocab, kinds)
    rounds = 0
    while len(vocab) < vocab_size and (max_rounds is None or rounds < max_rounds):
        m = min(max(merges_per_round, int(growth * len(vocab))), vocab_size - len(vocab))
        pairs = pair_counts(wc).where(F.col("n") >= min_pair_count).orderBy(F.col("n").desc(), "left", "right")
        look, chosen = 4 * m + 16, []
        while not chosen:
            top = pairs.limit(look).collect()
            chosen = choose_merges([(r.left, r.right, r.n) for r in top], m, taken)
            if len(top) < look:
                break
            look *= 4          # all of these are blocked: look further down
        if not chosen:
            break
        merges = {(a, b): merged_token(a, b) for a, b, _ in chosen}
        vocab += [merged_token(a, b) for a, b, _ in chosen]
        kinds += ["merge"] * len(chosen)
        nxt = wc.select(apply_merges(F.col("syms"), merges).alias("syms"), "n")
        rounds += 1
        if rounds % checkpoint_every == 0:
            nxt = nxt.checkpoint()          # reliable, in the shared checkpoint folder
        else:
            nxt = nxt.persist(StorageLevel.MEMORY_AND_DISK)
            nxt.count()                     # materialize before the previous round is dropped
        wc.unpersist()
        wc = nxt
    return _vocab_table(spark, vocab, kinds)


def _vocab_table(spark, vocab: list, kinds: list) -> DataFrame:
    rows = [(t, i, k) for i, (t, k) in enumerate(zip(vocab, kinds))]
    return spark.createDataFrame(rows, "token string, id int, kind string")


def fixed_vocab(df: DataFrame, text_col: str = "text", top_words: int = 500) -> DataFrame:
    """A vocabulary made by rule (for checks): specials, every character in
    both forms, then the ``top_words`` most frequent words of 2+ characters.
    """
    wc = word_counts(df, text_col).persist(StorageLevel.MEMORY_AND_DISK)   # read twice below
    chars = explode_rows(wc, [], F.regexp_extract_all("word", F.lit(CHAR), 0), "c").distinct()
    specials = df.sparkSession.createDataFrame(
        [(t, 0, i) for i, t in enumerate(SPECIALS)], "token string, grp int, k bigint")
    c0 = chars.select(F.col("c").alias("token"), F.lit(1).alias("grp"), F.lit(0).cast("bigint").alias("k"))
    c1 = chars.select(F.concat(F.lit(CONT), "c").alias("token"), F.lit(2).alias("grp"),
                      F.lit(0).cast("bigint").alias("k"))
    top = (wc.where(F.length("word") > 1).orderBy(F.col("n").desc(), "word").limit(top_words)
           .select(F.col("word").alias("token"), F.lit(3).alias("grp"), (-F.col("n")).alias("k")))
    allv = specials.unionByName(c0).unionByName(c1).unionByName(top)
    w = Window.orderBy("grp", "k", "token")          # bounded: alphabet + top_words rows
    return allv.select("token", (F.row_number().over(w) - 1).cast("int").alias("id"))


def save_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Vocabulary as parquet (``mode='ignore'`` keeps an existing one)."""
    vocab.coalesce(1).write.mode(mode).parquet(path)


def load_vocab(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_or_build_vocab(spark, path: str, build) -> DataFrame:
    """Reuse a saved vocabulary, else build, save and return it."""
    from ..sources.files import _fs_exists
    if not _fs_exists(spark, path):
        save_vocab(build(), path)
    return load_vocab(spark, path)
