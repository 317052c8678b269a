"""Greedy longest-match subword encoding (K2-K7).

The vocabulary, once its bytes are checked, is broadcast and built into a trie once
per Python worker.  An Arrow UDF walks it for the distinct words of each batch
and puts the pieces back in place of every occurrence with array
arithmetic: one row in, one row out, no exchange, whatever the number of words.
ASCII texts go to it whole and are cut into words by array arithmetic too (``ascii_words``).
Ids become token texts by a lookup in one literal array inside the JVM, and decoded text
by Arrow kernels.

A vocabulary beyond ``BROADCAST_BYTES`` is looked up by joins instead: the distinct
words are segmented as rows and joined back to their occurrences.
"""

from __future__ import annotations

import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vocab import CLS_ID, CONT, PAD_ID, SEP_ID, SPECIALS, UNK_ID, ascii_text, other_words, split_words, words

# Distinct words whose pieces a worker remembers; beyond it, it starts anew.
MEMO_WORDS = 1 << 18
# Vocabularies with longer tokens are always walked as a trie: there a word takes a step per character and piece.
SHORT_TOKEN = 32
_CODE_POINTS = 0x110000


class WordPieces:
    """A vocabulary as a trie: node and character give the next node.

    Node 0 starts a word and knows every token as it stands; node 1 continues
    one and knows the tokens that start with ``##``, without that mark.
    """

    def __init__(self, tokens: list, ids: list):
        edges, ends = {}, [-1, -1]

        def add(node, chars, number):
            for c in chars:
                key = node * _CODE_POINTS + ord(c)
                nxt = edges.get(key)
                if nxt is None:
                    nxt = edges[key] = len(ends)
                    ends.append(-1)
                node = nxt
            ends[node] = number

        # Of short tokens the longest fit is found sooner by their texts: (those that start a word, the others).
        first = {token: number for token, number in zip(tokens, ids) if token}
        inner = {token[len(CONT):]: number for token, number in first.items() if token.startswith(CONT) and len(token) > len(CONT)}
        self._longest = max(map(len, first), default=0)
        self._short = (first, inner) if self._longest <= SHORT_TOKEN else None

        for token, number in zip(tokens, ids):
            if token:
                add(0, token, number)
            if token.startswith(CONT) and len(token) > len(CONT):
                add(1, token[len(CONT):], number)
        self._edges, self._ends = edges, ends
        self._forget()

    def _forget(self):
        """Known words: word -> number; the pieces of all of them in a row, and where those of each number end."""
        self._memo, self._known, self._stops = {}, array("i"), array("q", [0])

    def pieces(self, word: str) -> tuple:
        """Ids of the longest pieces from left to right; UNK where none fits."""
        if self._short is not None:
            return self._short_pieces(word)
        edges, ends = self._edges, self._ends
        out, at, n = [], 0, len(word)
        while at < n:
            node, j, best = (1 if at else 0), at, -1
            while j < n:
                node = edges.get(node * _CODE_POINTS + ord(word[j]))
                if node is None:
                    break
                j += 1
                if ends[node] >= 0:
                    best, stop = ends[node], j
            if best < 0:
                return (UNK_ID,)
            out.append(best)
            at = stop
        return tuple(out) if out else (UNK_ID,)

    def _short_pieces(self, word: str) -> tuple:
        known, inner = self._short
        out, at, n, longest = [], 0, len(word), self._longest
        while at < n:
            for stop in range(min(n, at + longest), at, -1):
                number = known.get(word[at:stop])
                if number is not None:
                    break
            else:
                return (UNK_ID,)
            out.append(number)
            at, known = stop, inner
        return tuple(out) if out else (UNK_ID,)

    def pieces_of(self, column: pa.Array) -> tuple:
        """(number of pieces per word, all pieces) of a string array; a NULL word has none."""
        coded = column.dictionary_encode()
        found = _strings(coded.dictionary)
        if len(self._memo) + len(found) > MEMO_WORDS:
            self._forget()
        memo, known, stops = self._memo, self._known, self._stops
        numbers = list(map(memo.get, found))
        for i in [i for i, x in enumerate(numbers) if x is None]:
            numbers[i] = memo[found[i]] = len(stops) - 1
            known.extend(self.pieces(found[i]))
            stops.append(len(known))
        flat, ends, numbers = np.array(known, np.int32), np.array(stops, np.int64), np.array(numbers, np.int64)
        start = np.append(ends[numbers], 0)
        size = np.append(ends[numbers + 1] - ends[numbers], 0)          # the last is that of a NULL word
        which = pc.fill_null(coded.indices, len(found)).to_numpy(zero_copy_only=False).astype(np.int64)
        size = size[which]
        inner = np.concatenate([[0], np.cumsum(size)])
        return size, flat[np.repeat(start[which] - inner[:-1], size) + np.arange(inner[-1])]

    def segment(self, column: pa.Array) -> pa.Array:
        """list<string> -> list<list<int>>: the pieces of every word of a batch."""
        size, flat = self.pieces_of(column.flatten())
        return _lists(list_sizes(column), _lists(size, pa.array(flat)))


def _strings(column: pa.Array) -> list:
    """``to_pylist`` of strings without NULL; ASCII ones are decoded at once."""
    if column.type != pa.string() or not len(column) or column.null_count:
        return column.to_pylist()
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].tolist()
    data = column.buffers()[2]
    text = data[:ends[-1]].to_pybytes() if data is not None else b""
    if not text.isascii():
        return column.to_pylist()
    text = text.decode("ascii")
    return [text[i:j] for i, j in zip(ends, ends[1:])]


def list_sizes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(sizes).astype(np.int32)), values)


def _vocab_rows(vocab: DataFrame) -> list | None:
    """``(token, id)`` rows at the driver, or None if they pass ``BROADCAST_BYTES``."""
    size = vocab.agg(F.sum(F.octet_length("token") + 16)).first()[0] or 0
    return vocab.select("token", "id").collect() if size <= BROADCAST_BYTES else None


def shared_trie(vocab: DataFrame):
    """A function that gives the trie of the vocabulary inside a task, or None for a
    vocabulary that is too large to broadcast."""
    rows = _vocab_rows(vocab)
    if rows is None:
        return None
    shared = vocab.sparkSession.sparkContext.broadcast({"tokens": [r.token for r in rows], "ids": [r.id for r in rows]})

    def trie() -> WordPieces:
        known = shared.value                    # one object per worker process: the trie stays with it
        if "trie" not in known:
            known["trie"] = WordPieces(known["tokens"], known["ids"])
        return known["trie"]

    return trie


def segmenter(vocab: DataFrame):
    """A function array<string> Column -> array<array<int>> Column, or None for a
    vocabulary that is too large to broadcast."""
    trie = shared_trie(vocab)
    if trie is None:
        return None

    @F.arrow_udf("array<array<int>>")
    def pieces_of(column: pa.Array) -> pa.Array:
        return trie().segment(column)

    return pieces_of


def text_encoder(vocab: DataFrame):
    """A function text Column -> array<int> Column with the pieces of all its words,
    or None for a vocabulary that is too large to broadcast."""
    trie = shared_trie(vocab)
    if trie is None:
        return None

    @F.arrow_udf("array<int>")
    def ids_of(text: pa.Array, others: pa.Array) -> pa.Array:
        rows, found = split_words(text, others)
        size, flat = trie().pieces_of(found)
        ends = _offsets(size)[_offsets(rows)]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))

    return lambda text: ids_of(ascii_text(text), other_words(text))


def _names(vocab: DataFrame) -> list | None:
    """Tokens by id (UNK in the gaps), or None where they cannot be one array."""
    rows = _vocab_rows(vocab)
    if rows is None or any(r.id < 0 for r in rows) or max((r.id for r in rows), default=0) > 4 * len(rows) + 64:
        return None
    names = [SPECIALS[UNK_ID]] * (max((r.id for r in rows), default=0) + 1)
    for r in rows:
        names[r.id] = r.token
    return names


def token_names(vocab: DataFrame):
    """A function array<int> Column -> array<string> Column (UNK for unknown ids),
    or None where the tokens cannot be one literal array."""
    names = _names(vocab)
    if names is None:
        return None
    text = "".join(names)
    mark = next((m for m in "\x1f\x1e\x1d\x1c\x01\x02" if m not in text), None)
    if mark is None:
        return None
    # A literal split into an array is folded to one literal when the query is planned.
    known = F.split(F.lit(mark.join(names)), mark, -1)

    def names_of(ids) -> Column:
        c = F.col(ids) if isinstance(ids, str) else ids
        return F.coalesce(F.transform(c, lambda x: F.coalesce(F.get(known, x), F.lit(SPECIALS[UNK_ID]))),
                          F.array().cast("array<string>"))

    return names_of


def join_names(column: pa.Array, names: pa.Array, dropped: np.ndarray) -> pa.Array:
    """list<int> -> text of every row: its names but the dropped ones, joined by spaces,
    continuations glued.  The last name stands for unknown ids; a NULL list gives ''."""
    rows = list_sizes(column)
    last = len(names) - 1
    ids = pc.fill_null(column.flatten(), last).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = np.where((ids < 0) | (ids > last), last, ids)
    keep = ~dropped[ids]
    ends = _offsets(keep)[_offsets(rows)]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names.take(pa.array(ids[keep])))
    return pc.replace_substring(pc.binary_join(lists, " "), " " + CONT, "")


def text_of_ids(vocab: DataFrame, skip_special_tokens: bool = True):
    """A function array<int> Column -> text Column (``tokens_to_text`` of its tokens),
    or None where the tokens cannot be one array."""
    names = _names(vocab)
    if names is None:
        return None
    shared = vocab.sparkSession.sparkContext.broadcast({"names": names + [SPECIALS[UNK_ID]]})

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        known = shared.value
        if "table" not in known:
            known["table"] = pa.array(known["names"], pa.string())
            known["special"] = np.array([n in SPECIALS for n in known["names"]])
        return join_names(column, known["table"], known["special"] & skip_special_tokens)

    return lambda ids: text_of(F.col(ids) if isinstance(ids, str) else ids)


# The UDF travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[split_words.__module__])

# Tells rows with equal ids apart while their words are taken apart.
ROW_KEY = "_row_key"
# Lookup tables up to this many bytes of text and ids are broadcast into joins.
BROADCAST_BYTES = 64 << 20


def _small(vocab: DataFrame, token: str = "token") -> DataFrame:
    """Broadcast hint for a vocabulary whose size in bytes was checked."""
    size = vocab.agg(F.sum(F.octet_length(token) + 16)).first()[0] or 0
    return F.broadcast(vocab) if size <= BROADCAST_BYTES else vocab


def _small_segments(seg: DataFrame) -> DataFrame:
    """Broadcast hint for segmented words, by their bytes (a word may be long)."""
    size = seg.agg(F.sum(F.octet_length("word") * 2 + F.size("ids") * 12 + 64)).first()[0] or 0
    return F.broadcast(seg) if size <= BROADCAST_BYTES else seg


def max_piece_chars(vocab: DataFrame) -> tuple[int, int]:
    """Longest initial piece and longest ``##`` piece (characters after ``##``)."""
    cont = F.col("token").startswith(CONT)
    r = vocab.agg(F.max(F.when(~cont, F.length("token"))).alias("a"),
                  F.max(F.when(cont, F.length("token") - len(CONT))).alias("b")).first()
    return int(r["a"] or 0), int(r["b"] or 0)


def segment_words(distinct_words: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(word, ids array<int>, toks array<string>)`` for each distinct word.

    Candidates are (start, length) pieces up to the longest vocabulary piece
    of their form; one broadcast hash join keeps those in the vocabulary;
    one ordered collect per word (start ascending, length descending) feeds
    a linear greedy walk.  The words arrive hash-partitioned by ``word``
    (they are distinct), so the collect needs no further exchange.
    """
    l0, l1 = max_piece_chars(vocab)
    w = (distinct_words.select("word")
         .withColumn("nc", F.length("word"))
         .persist(StorageLevel.MEMORY_AND_DISK))         # read by the candidates and the walk
    lmax = F.when(F.col("i") == 0, F.lit(l0)).otherwise(F.lit(l1))
    cand = (w.where(F.col("nc") > 0)
            .select("word", "nc", F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("i"))
            .where(lmax > 0)
            .select("word", "i",
                    F.explode(F.sequence(F.lit(1), F.least(lmax, F.col("nc") - F.col("i")))).alias("l"))
            .select("word", "i", "l",
                    F.concat(F.when(F.col("i") > 0, F.lit(CONT)).otherwise(F.lit("")),
                             F.substring("word", F.col("i") + 1, F.col("l"))).alias("token")))
    v = _small(vocab.select("token", "id"))          # checked: bounded by vocab_size
    hits = (cand.join(v, "token")
            .groupBy("word")
            .agg(F.array_sort(F.collect_list(F.struct("i", (-F.col("l")).alias("nl"), "id")))
                 .alias("hs")))
    j = w.join(hits, "word", "left")
    init = F.struct(F.lit(0).alias("pos"), F.lit(True).alias("ok"),
                    F.array().cast("array<int>").alias("ids"),
                    F.array().cast("array<string>").alias("toks"))

    def step(acc, h):
        ln = -h["nl"]
        tok = F.concat(F.when(h["i"] > 0, F.lit(CONT)).otherwise(F.lit("")),
                       F.substring(F.col("word"), h["i"] + 1, ln))
        take = F.struct((h["i"] + ln).alias("pos"), F.lit(True).alias("ok"),
                        F.concat(acc["ids"], F.array(h["id"])).alias("ids"),
                        F.concat(acc["toks"], F.array(tok)).alias("toks"))
        fail = F.struct(acc["pos"].alias("pos"), F.lit(False).alias("ok"),
                        acc["ids"].alias("ids"), acc["toks"].alias("toks"))
        return (F.when(~acc["ok"] | (h["i"] < acc["pos"]), acc)
                .when(h["i"] == acc["pos"], take)
                .otherwise(fail))                       # nothing starts at pos

    walk = F.aggregate(F.coalesce("hs", F.array().cast("array<struct<i:int,nl:int,id:int>>")),
                       init, step)
    good = walk["ok"] & (walk["pos"] == F.col("nc")) & (F.col("nc") > 0)
    return j.select("word",
                    F.when(good, walk["ids"]).otherwise(F.array(F.lit(UNK_ID))).alias("ids"),
                    F.when(good, walk["toks"]).otherwise(F.array(F.lit(SPECIALS[UNK_ID]))).alias("toks"))


def _pieces_by_join(df: DataFrame, id_cols: list[str], word_array: Column, vocab: DataFrame,
                    tag_array: Column | None = None) -> DataFrame:
    """``word_pieces`` for a vocabulary of any size: occurrences are exploded once
    (persisted), joined with the segmented distinct words, and re-collected per
    generated row key.
    """
    keyed = df.withColumn(ROW_KEY, F.monotonically_increasing_id())
    if tag_array is None:
        occ = keyed.select(*id_cols, ROW_KEY, F.posexplode_outer(word_array).alias("widx", "word"),
                           F.lit(None).cast("int").alias("tag"))
    else:
        occ = (keyed.select(*id_cols, ROW_KEY, F.posexplode_outer(F.arrays_zip(word_array.alias("w"),
                                                                               tag_array.alias("t")))
                            .alias("widx", "z"))
               .select(*id_cols, ROW_KEY, "widx", F.col("z.w").alias("word"), F.col("z.t").alias("tag")))
    occ = occ.persist(StorageLevel.MEMORY_AND_DISK)
    dw = occ.where(F.col("word").isNotNull()).select("word").distinct()
    seg = segment_words(dw, vocab).persist(StorageLevel.MEMORY_AND_DISK)
    j = occ.join(_small_segments(seg), "word", "left")
    item = F.when(F.col("widx").isNotNull(), F.struct(
        "widx", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"), "word", "tag"))
    out = (j.groupBy(ROW_KEY, *id_cols)
           .agg(F.array_sort(F.collect_list(item)).alias("ws"))
           .select(*id_cols, F.transform("ws", lambda x: x["ids"]).alias("pieces"),
                   F.transform("ws", lambda x: x["word"]).alias("words"),
                   F.transform("ws", lambda x: x["tag"]).alias("tags")))
    return out if tag_array is not None else out.drop("tags")


def word_pieces(df: DataFrame, id_cols: list[str], word_array: Column, vocab: DataFrame,
                tag_array: Column | None = None) -> DataFrame:
    """K4: ``(ids..., pieces array<array<int>>, words array<string>[, tags
    array<int>])`` for an array of words per row, in word order.

    One row in, one row out, so ``id_cols`` may name any columns to carry along and
    may repeat.  A row without words has empty arrays; a NULL word keeps its
    slot, with no pieces.
    """
    pieces_of = segmenter(vocab)
    if pieces_of is None:
        return _pieces_by_join(df, id_cols, word_array, vocab, tag_array)
    none = F.array().cast("array<string>")
    tags = [] if tag_array is None else [F.coalesce(tag_array, F.array().cast("array<int>")).alias("tags")]
    rows = df.select(*id_cols, F.coalesce(word_array, none).alias("words"), *tags)
    return rows.select(*id_cols, pieces_of("words").alias("pieces"), "words", *[c for c in rows.columns if c == "tags"])


def encode(df: DataFrame, id_cols: list[str], vocab: DataFrame, text_col: str = "text",
           max_length: int | None = 128, truncation: bool = True,
           add_special_tokens: bool = True) -> DataFrame:
    """K2: ``input_ids, token_type_ids, attention_mask`` and ``n_pieces``
    (the length before truncation; every word of the text is encoded)."""
    ids_of = text_encoder(vocab)
    if ids_of is not None:
        wp = df.select(*id_cols, ids_of(F.col(text_col)).alias("_ids"))
    else:
        wp = word_pieces(df, id_cols, words(text_col), vocab).select(*id_cols, F.flatten("pieces").alias("_ids"))
    ids = F.col("_ids")
    keep = (max_length - 2 if add_special_tokens else max_length) if (truncation and max_length) else None
    cut = F.slice(ids, 1, keep) if keep is not None else ids
    full = (F.concat(F.array(F.lit(CLS_ID)), cut, F.array(F.lit(SEP_ID))) if add_special_tokens else cut)
    return (wp.select(*id_cols, F.size(ids).cast("bigint").alias("n_pieces"), full.alias("input_ids"))
            .withColumn("token_type_ids", F.array_repeat(F.lit(0), F.size("input_ids")))
            .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))))


def truncate_pair(la: Column, lb: Column, budget: int) -> tuple[Column, Column]:
    """Longest-first truncation: remove from the longer side, from the
    second one on ties, until ``la + lb <= budget``."""
    over = (la + lb) > F.lit(budget)
    half_up = F.lit((budget + 1) // 2)
    na = F.when(over, F.least(la, F.greatest(F.lit(budget) - lb, half_up))).otherwise(la)
    nb = F.when(over, F.lit(budget) - na).otherwise(lb)
    return na, nb


def encode_pairs(df: DataFrame, id_cols: list[str], vocab: DataFrame, a_col: str = "sentence1",
                 b_col: str = "sentence2", max_length: int = 128) -> DataFrame:
    """K3: ``[CLS] a [SEP] b [SEP]`` with segment ids 0/1 and longest-first cut."""
    # The words of both sides as one array; the first side's count splits it again.
    wa, wb = (F.coalesce(words(c), F.array().cast("array<string>")) for c in (a_col, b_col))
    sides = df.select(*id_cols, F.size(wa).alias("_na"), F.concat(wa, wb).alias("_w"))
    wp = word_pieces(sides, [*id_cols, "_na"], F.col("_w"), vocab)
    x = wp.select(*id_cols, F.flatten(F.slice("pieces", F.lit(1), F.col("_na"))).alias("a"),
                  F.flatten(F.slice("pieces", F.col("_na") + 1, F.size("pieces"))).alias("b"))
    na, nb = truncate_pair(F.size("a"), F.size("b"), max_length - 3)
    x = x.select(*id_cols, F.slice("a", 1, na).alias("a"), F.slice("b", 1, nb).alias("b"))
    ids = F.concat(F.array(F.lit(CLS_ID)), F.col("a"), F.array(F.lit(SEP_ID)), F.col("b"),
                   F.array(F.lit(SEP_ID)))
    seg_ids = F.concat(F.array_repeat(F.lit(0), F.size("a") + 2), F.array_repeat(F.lit(1), F.size("b") + 1))
    return x.select(*id_cols, ids.alias("input_ids"), seg_ids.alias("token_type_ids"),
                    F.array_repeat(F.lit(1), F.size("a") + F.size("b") + 3).alias("attention_mask"))


def ids_to_tokens(df: DataFrame, id_cols: list[str], ids_col: str, vocab: DataFrame) -> DataFrame:
    """K6: ``tokens`` for an id array; one row in, one row out."""
    names_of = token_names(vocab)
    if names_of is not None:
        return df.select(*id_cols, names_of(ids_col).alias("tokens"))
    occ = (df.withColumn(ROW_KEY, F.monotonically_increasing_id())
           .select(*id_cols, ROW_KEY, F.posexplode_outer(ids_col).alias("_pos", "_id")))
    names = vocab.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    j = occ.join(_small(names, "_token"), "_id", "left")
    item = F.when(F.col("_pos").isNotNull(),
                  F.struct("_pos", F.coalesce("_token", F.lit(SPECIALS[UNK_ID])).alias("token")))
    return (j.groupBy(ROW_KEY, *id_cols)
            .agg(F.array_sort(F.collect_list(item)).alias("_ts"))
            .select(*id_cols, F.transform("_ts", lambda x: x["token"]).alias("tokens")))


def tokens_to_text(tokens, skip_special_tokens: bool = True) -> Column:
    """K7: join tokens with spaces and glue ``##`` continuations."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    if skip_special_tokens:
        specials = F.array(*[F.lit(s) for s in SPECIALS])
        t = F.filter(t, lambda x: ~F.array_contains(specials, x))
    return F.replace(F.array_join(t, " "), F.lit(" " + CONT), F.lit(""))


def with_texts(df: DataFrame, texts: dict, vocab: DataFrame, skip_special_tokens: bool = True) -> DataFrame:
    """Adds text columns (name -> id array column); one row in, one row out."""
    text_of = text_of_ids(vocab, skip_special_tokens)
    if text_of is not None:
        return df.select("*", *[text_of(ids).alias(name) for name, ids in texts.items()])
    for name, ids in texts.items():
        df = (ids_to_tokens(df, df.columns, ids, vocab)
              .withColumn(name, tokens_to_text("tokens", skip_special_tokens)).drop("tokens"))
    return df


def decode(df: DataFrame, id_cols: list[str], ids_col: str, vocab: DataFrame,
           skip_special_tokens: bool = True) -> DataFrame:
    """K7: ids -> text."""
    rows = df.select(*id_cols, F.col(ids_col).alias("_ids"))
    return with_texts(rows, {"text": "_ids"}, vocab, skip_special_tokens).select(*id_cols, "text")


def pad_or_cut(v, length: int, pad) -> Column:
    """Pad to ``length`` with ``pad`` or keep the first ``length``."""
    c = F.col(v) if isinstance(v, str) else v
    padv = pad if isinstance(pad, Column) else F.lit(pad)
    n = F.greatest(F.lit(length) - F.size(c), F.lit(0))
    return F.slice(F.concat(c, F.array_repeat(padv, n)), 1, length)


__all__ = ["WordPieces", "segmenter", "text_encoder", "text_of_ids", "with_texts", "token_names", "segment_words", "word_pieces", "encode", "encode_pairs", "ids_to_tokens", "decode",
           "tokens_to_text", "pad_or_cut", "truncate_pair", "PAD_ID"]
