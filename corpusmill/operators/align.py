"""NER label alignment to subwords (K4, K8-K12) and tagged-token derivation."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .encode import list_sizes, pad_or_cut, shared_trie, with_texts, word_pieces
from .vocab import CLS_ID, PAD_ID, SEP_ID, words

# The UDF travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NULL_LABEL = -100


def rule_tags(tokens) -> Column:
    """Tag per word: 1 = starts upper-case, 2 = all digits, else 0."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    # Strings compare by their bytes: a first character between A and Z, or between 0 and 9.
    return F.transform(t, lambda w: F.when((w >= "A") & (w < "["), 1)
                       .when((w >= "0") & (w < ":") & w.rlike("^[0-9]+$"), 2).otherwise(0))


def tagged_tokens(df: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """S5 stand-in: ``(ids..., tokens, ner_tags)`` from plain text rows."""
    return (df.select(*id_cols, words(text_col).alias("tokens"))
            .withColumn("ner_tags", rule_tags("tokens")))


def align_batch(rows, size, flat, tags: pa.Array, max_length: int | None, specials: tuple | None,
                null_label: int) -> list:
    """Id, mask, word id and label lists of a batch: ``rows`` words per row, ``size`` pieces
    per word, ``flat`` all pieces; padded to or cut at ``max_length``."""
    first_word = np.cumsum(rows) - rows
    row = np.repeat(np.arange(len(rows)), rows)                 # of each word
    word = np.arange(len(size)) - first_word[row]
    # The tag of each word: NULL where there are fewer tags.
    n_tags = list_sizes(tags)
    flat_tags = tags.flatten()
    values = np.append(pc.fill_null(flat_tags, 0).to_numpy(zero_copy_only=False).astype(np.int32), 0)
    known = np.append(flat_tags.is_valid().to_numpy(zero_copy_only=False), False)
    at = np.where(word < n_tags[row], (np.cumsum(n_tags) - n_tags)[row] + word, len(values) - 1)
    pieces = np.bincount(row, weights=size, minlength=len(rows)).astype(np.int64)
    shift = 1 if specials else 0
    full = pieces + 2 * shift
    length = full if max_length is None else np.full(len(rows), max_length, np.int64)
    start = np.cumsum(length) - length
    total = int(length.sum())
    row_of = np.repeat(row, size)                               # of each piece
    place = np.arange(len(flat)) - (np.cumsum(pieces) - pieces)[row_of] + shift
    fits = place < length[row_of]
    to = (start[row_of] + place)[fits]
    head = (np.arange(len(flat)) == np.repeat(np.cumsum(size) - size, size))[fits]
    word_of = np.repeat(np.arange(len(size)), size)[fits]
    ids, mask = np.full(total, PAD_ID, np.int32), np.zeros(total, np.int32)
    wids, no_wid = np.zeros(total, np.int32), np.ones(total, bool)
    labels, no_label = np.full(total, null_label, np.int32), np.zeros(total, bool)
    ids[to] = flat[fits]
    mask[to] = 1
    wids[to] = word[word_of]
    no_wid[to] = False
    labels[to[head]] = values[at[word_of[head]]]
    no_label[to[head]] = ~known[at[word_of[head]]]
    if specials:
        for token, place in ((specials[0], np.zeros(len(rows), np.int64)), (specials[1], pieces + 1)):
            to = (start + place)[place < length]
            ids[to] = token
            mask[to] = 1
    ends = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, v) for v in (
        pa.array(ids), pa.array(mask), pa.array(wids, mask=no_wid), pa.array(labels, mask=no_label))]


def _aligned_columns(max_length, add_special_tokens, null_label) -> list:
    """The columns of ``align_batch`` from ``pieces`` and ``tags``, for rows whose pieces were joined."""
    pieces = F.col("pieces")
    wid = F.flatten(F.transform(pieces, lambda p, i: F.array_repeat(i, F.size(p))))
    # A NULL token has no pieces, so no label either; word ids still count it.
    lab = F.flatten(F.zip_with(pieces, F.col("tags"), lambda p, t: F.slice(F.concat(
        F.array(t), F.array_repeat(F.lit(null_label), F.size(p))), F.lit(1), F.coalesce(F.size(p), F.lit(0)))))
    ids = F.flatten(pieces)
    cols = {
        "input_ids": (ids, CLS_ID, SEP_ID, PAD_ID),
        "attention_mask": (F.array_repeat(F.lit(1), F.size(ids)), 1, 1, 0),
        "word_ids": (wid, None, None, None),
        "labels": (lab, null_label, null_label, null_label),
    }
    out = []
    for name, (v, cls, sep, pad) in cols.items():
        if add_special_tokens:
            v = F.concat(F.array(F.lit(cls).cast("int")), v, F.array(F.lit(sep).cast("int")))
        if max_length is not None:
            v = pad_or_cut(v, max_length, F.lit(pad).cast("int"))
        out.append(v.alias(name))
    return out


def align_labels(df: DataFrame, id_cols: list[str], vocab: DataFrame, tokens_col: str = "tokens",
                 tags_col: str = "ner_tags", max_length: int | None = 128,
                 add_special_tokens: bool = True, null_label: int = NULL_LABEL,
                 check_lengths: bool = False, keep_tags: bool = False) -> DataFrame:
    """``input_ids, token_type_ids, attention_mask, word_ids, labels,
    words, text`` per row; word id repeated per piece (K8), label on the
    first piece only (K9), CLS/SEP added, then padded to or cut at
    ``max_length`` (K10; a cut may drop SEP, as in the reference).  With
    ``keep_tags`` also ``ner_tags``, the tag of each word.
    """
    tokens = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
    tags = F.coalesce(F.col(tags_col), F.array().cast("array<int>"))
    trie = shared_trie(vocab)
    specials = (CLS_ID, SEP_ID) if add_special_tokens else None
    names = ("input_ids", "attention_mask", "word_ids", "labels")
    if trie is not None:
        @F.arrow_udf(", ".join(f"{n} array<int>" for n in names))
        def aligned(words: pa.Array, tags: pa.Array) -> pa.Array:
            size, flat = trie().pieces_of(words.flatten())
            cols = align_batch(list_sizes(words), size, flat, tags, max_length, specials, null_label)
            return pa.StructArray.from_arrays(cols, list(names))

        rows = df.select(*id_cols, tokens.alias("words"), tags.alias("tags"))
        x = rows.select("*", aligned("words", "tags").alias("_a"))
        out = [F.col("_a")[n].alias(n) for n in names]
    else:
        x = word_pieces(df, id_cols, tokens, vocab, tag_array=tags)
        out = _aligned_columns(max_length, add_special_tokens, null_label)
    # tags travel with their words, so the rows need no join back
    res = x.select(*id_cols, *out, "words", *([F.col("tags").alias("ner_tags")] if keep_tags else []))
    res = res.select(*id_cols, "input_ids", F.array_repeat(F.lit(0), F.size("input_ids")).alias("token_type_ids"),
                     *res.columns[len(id_cols) + 1:])
    # The text comes from the ids that were kept, in the same row.
    res = with_texts(res, {"text": "input_ids"}, vocab)
    if check_lengths:
        # Every per-token array has one length (max_length when padding)
        want = F.lit(max_length) if max_length is not None else F.size("input_ids")
        ok = F.lit(True)
        for c in ("input_ids", "token_type_ids", "attention_mask", "word_ids", "labels"):
            ok = ok & (F.size(c) == want)
        res = res.withColumn("_ok", F.assert_true(ok, "aligned arrays differ in length")).drop("_ok")
    return res
