"""Vectorised words and word hashes of UTF-8 text (numpy, inside tasks).

A word is a maximal run of bytes outside [\\x20\\x09-\\x0D].  Its 64-bit hash
is a polynomial in fixed random byte values, taken for all words of a block
at once from one running sum.  Words that differ in one byte never collide;
others do with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240607)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_EXACT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Texts are cut at white space into blocks of about this many bytes.
BLOCK = 1 << 20


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            with np.errstate(over="ignore"):
                size = max(n, 1 << 16)
                cls.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _ODD, np.uint64))])
                cls.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _INVERSE, np.uint64))])
        return cls.up[:n], cls.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads all bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _block(data: np.ndarray, fold: bool):
    space = _IS_SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _Powers.of(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.cumsum((_FOLDED if fold else _EXACT)[data] * up[:len(data)], dtype=np.uint64)
        total = np.concatenate([[np.uint64(0)], total])
        h = (total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)
    return start, end, mix(h)


def words_of(data: np.ndarray, fold: bool = False):
    """(start bytes, end bytes, hashes) of all words of a whole text."""
    if len(data) <= BLOCK:
        return _block(data, fold)
    parts, lo = [], 0
    while lo < len(data):
        hi = min(len(data), lo + BLOCK)
        while hi < len(data):  # a word is never cut
            gap = np.flatnonzero(_IS_SPACE[data[hi:hi + BLOCK]])
            hi += int(gap[0]) if len(gap) else len(data[hi:hi + BLOCK])
            if len(gap):
                break
        s, e, h = _block(data[lo:hi], fold)
        parts.append((s + lo, e + lo, h))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*parts))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.full(m, np.uint64(n))
    with np.errstate(over="ignore"):
        for i in range(n):
            h = (h ^ hashes[i:i + m]) * _ODD
            h ^= h >> np.uint64(29)
    return mix(h)


def column_bytes(column) -> list:
    """The UTF-8 bytes of an Arrow string column, row by row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    ok = column.is_valid().to_numpy(zero_copy_only=False)
    return [data[a:b] if v else data[:0] for a, b, v in zip(at[:-1].tolist(), at[1:].tolist(), ok.tolist())]
