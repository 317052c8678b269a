"""Words of ASCII texts by array arithmetic (the word rule of ``patterns.WORD``).

A batch of texts is one byte buffer; the class of each byte (space, punctuation, other) says where
words begin.  Texts with other characters need the Unicode classes of the Java
pattern: their words come from it (``other_words``) and are put in their places.
"""

from __future__ import annotations

import sys

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

# Code that uses this module in UDFs travels with it, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KIND = np.full(256, 2, np.uint8)
_KIND[[*range(9, 14), *range(28, 33)]] = 0
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def ascii_text(text: Column) -> Column:
    """The text where it is ASCII, else NULL."""
    return F.when(is_ascii(text), text)


def other_words(text: Column) -> Column:
    """The words of a text that is not ASCII, else none.

    An empty array, not NULL: Arrow's list writer goes back over all NULL lists before each one, so
    that a batch of them would cost the square of its rows.
    """
    return F.when(~is_ascii(text), F.regexp_extract_all(text, F.lit(P.WORD), 0)).otherwise(F.array().cast("array<string>"))


def ascii_words(column: pa.Array) -> tuple:
    """(number of words per row, all words) of a string array; NULL has none."""
    column = pc.fill_null(column.cast(pa.string()), "")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or ends[0] == ends[-1]:
        return np.zeros(len(column), np.int64), pa.array([], pa.string())
    data = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    kind = _KIND[data]
    inner = kind == 2
    after = np.empty_like(inner)                # whether the byte before is inside the same text and a word's
    after[0] = False
    after[1:] = inner[:-1]
    after[ends[:-1][ends[:-1] < len(data)]] = False
    begins = (kind == 1) | (inner & ~after)
    seen = kind > 0
    starts = np.flatnonzero(begins[seen]).astype(np.int32)
    kept = data[seen]
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, np.int32(len(kept)))), pa.py_buffer(kept))
    before = np.concatenate([[0], np.cumsum(begins)])
    return np.diff(before[ends]), words


def split_words(text: pa.Array, others: pa.Array) -> tuple:
    """``ascii_words`` of a batch where rows with ``others`` (list<string>) have those words."""
    rows, words = ascii_words(text)
    more = pc.fill_null(pc.list_value_length(others), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not more.any():
        return rows, words
    size = rows + more                          # one of the two is zero
    start = np.where(more > 0, len(words) + np.cumsum(more) - more, np.cumsum(rows) - rows)
    first = np.cumsum(size) - size
    take = np.repeat(start - first, size) + np.arange(size.sum())
    return size, pa.concat_arrays([words, others.flatten().cast(pa.string())]).take(pa.array(take))


# Bytes of text cut into words at once, and distinct words that a task holds before it hands them on.
SLICE, HELD = 1 << 21, 1 << 17


def slices(text: pa.Array, others: pa.Array) -> Iterator:
    """The two columns in pieces of about ``SLICE`` bytes of text (a row stays whole)."""
    size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    size += 8 * pc.fill_null(pc.list_value_length(others), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // SLICE
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(text)]
    for i, j in zip(cuts, cuts[1:]):
        if j > i:
            yield text.slice(i, j - i), others.slice(i, j - i)


def count_words(batches) -> Iterator:
    """(word, n) of batches of (ASCII text or NULL, words of other texts or NULL): equal words of a task are counted
    together as long as they are few."""
    def together(tables):
        return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    held, rows, limit = [], 0, HELD
    for batch in batches:
        for text, others in slices(batch.column(0), batch.column(1)):
            counts = split_words(text, others)[1].value_counts()
            held.append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
            rows += len(counts)
        if rows >= 2 * limit:
            held = [together(held)]
            rows = held[0].num_rows
            if rows >= limit:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from together(held).to_batches()
