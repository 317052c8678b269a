"""MD5 of many short texts at once by array arithmetic.

A text that fits one block (55 bytes) takes the 64 steps of the algorithm as operations on arrays of
``LANES`` texts; longer ones go to ``hashlib``.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Code that uses this module in UDFs travels with it, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LANES = 1 << 14
_FITS = 55
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_ADD = [int(abs(np.sin(np.float64(i + 1))) * 2 ** 32) for i in range(64)]
_TURN = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for _ in range(4) for s in four]
_WORD = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]


def _steps(words: np.ndarray) -> list:
    """The four result words of blocks given as 16 arrays of 32-bit words."""
    used = [bool(w.any()) for w in words]
    a, b, c, d = (np.full(words.shape[1], x, np.uint32) for x in _START)
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:                              # (b & c) | (~b & d)
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:                            # (d & b) | (~d & c)
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:                                   # c ^ (b | ~d)
            np.bitwise_not(d, out=f)
            f |= b
            f ^= c
        f += a
        f += np.uint32(_ADD[i])
        if used[_WORD[i]]:
            f += words[_WORD[i]]
        np.right_shift(f, np.uint32(32 - _TURN[i]), out=g)
        f <<= np.uint32(_TURN[i])
        f |= g
        f += b
        a, b, c, d, f = d, f, b, c, a
    for x, start in zip((a, b, c, d), _START):
        x += np.uint32(start)
    return [a, b, c, d]


def md5_of_numbered(keys: pa.Array, row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Array (texts, 4): the digest of each text ``keys[row]`` + decimal ``number`` as four numbers,
    the first 8 hex digits first.  Numbers are not negative; a NULL key is empty."""
    out = np.empty((len(row), 4), np.uint32)
    if not len(row):
        return out
    keys = pc.fill_null(keys.cast(pa.string()), "")
    ends = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    # The decimals of every number that occurs, and how many it has.
    top = int(number.max()) + 1
    if top > 1 << 20:
        names, number = np.unique(number, return_inverse=True)
    else:
        names = np.arange(top)
    digits = np.char.mod(b"%d", names)
    width = digits.dtype.itemsize
    digits = digits.view(np.uint8).reshape(len(names), width)
    many = (digits > 0).sum(axis=1)
    # The first bytes of each key, zeros after its end.
    at = np.arange(64)
    inside = at < np.minimum(size, _FITS)[:, None]
    blocks = np.zeros((len(keys), 64), np.uint8)
    if len(data):
        blocks[inside] = data[np.minimum(ends[:-1, None] + at, len(data) - 1)[inside]]
    long = size[row] + width > _FITS
    for i in range(0, len(row), LANES):
        r, n = row[i:i + LANES], number[i:i + LANES]
        block = blocks[r]
        flat, end = block.reshape(-1), np.minimum(size[r], _FITS - width) + np.arange(len(r)) * 64
        for j in range(width):
            flat[end + j] = digits[n, j]
        length = np.minimum(size[r], _FITS - width) + many[n]
        flat[end + many[n]] = 0x80
        words = np.ascontiguousarray(block.view("<u4").T).astype(np.uint32, copy=False)
        words[14] = (length * 8).astype(np.uint32)
        for j, x in enumerate(_steps(words)):
            out[i:i + LANES, j] = x.byteswap()
    for i in np.flatnonzero(long).tolist():
        k = int(row[i])
        text = data[ends[k]:ends[k + 1]].tobytes() + b"%d" % names[number[i]]
        out[i] = np.frombuffer(hashlib.md5(text).digest(), ">u4")
    return out
