"""Exact sequential merges of a subword vocabulary (K1).

State is one table: the symbols of each distinct word as int32 codes, and the count of the word.
A round takes a run of merges that is provably the one that merging one pair at a time would take:

* All pairs are counted, and a floor is chosen: the count that some ``m`` pairs reach.
* Every word is cut wherever a pair counts less than the floor.  Equal pieces are counted together and come to the
  driver, ``WORKING_SYMBOLS`` symbols at most; ``m`` follows from that.
* There one pair after the other is merged (``merge_pieces``) until the best one counts less than the floor.  A pair that
  merging makes occurs at most as often as the pair at its seam.  So a pair across a cut stays
  below the floor for ever, and all others are counted in full in the pieces.
* The words are rewritten with these merges, batch by batch.

Where all symbols left fit, whole words come to the driver and the round is the last one.  Where even the
pairs of the highest count are too many, the first of them in order are merged from the stretches
around them (``stretches``, with the symbol on either side), or just the first one.

Words of one symbol have no pairs and leave the table.

Ranking: count descending, then left and right symbol.  A pair whose merged token
exists already is never merged.
"""

from __future__ import annotations

import heapq
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

# The UDF travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONT = "##"
# Symbols of pieces at the driver in one round, whatever the corpus (about 70 bytes each there).
WORKING_SYMBOLS = 1 << 22
# Pairs looked at in one round: at most, and in the first one.
LOOK = 1 << 18
FIRST = 64
# Tied pairs merged from stretches in one round, and their symbols.
TIED, TIED_SYMBOLS = 256, 1 << 19
# Bytes of symbols that a task works on at once.
CHUNK = 1 << 22
# Code of a character inside a word, less that of the same character at its start.
INNER = 0x110000
# Longer words are merged one by one, in time that does not grow with the square of their length.
LONG = 256
_COUNTED, _NONE, _END, _GONE = "left int, right int, n bigint", 1 << 30, -1, -2


def merged_token(left: str, right: str) -> str:
    return left + (right[len(CONT):] if right.startswith(CONT) else right)


# ----------------------------------------------------------------- words as codes
def packed(codes: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """One binary of int32 codes per word."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(
        np.ascontiguousarray(codes, np.int32))])


def unpacked(column: pa.Array) -> tuple:
    """(codes, number of codes per word) of a binary array."""
    if not len(column):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), np.int32), np.diff(ends) // 4


def _chunks(batches):
    """(codes, number of codes per word, count per word), some ``CHUNK`` bytes at a time."""
    held, size = [], 0

    def together():
        table = pa.Table.from_batches(held).combine_chunks()
        codes, sizes = unpacked(table.column(0).chunk(0))
        return codes, sizes, table.column(1).to_numpy()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(0).nbytes
        if size >= CHUNK:
            yield together()
            held, size = [], 0
    if held:
        yield together()


def coded_words(words: DataFrame) -> DataFrame:
    """(syms, n) of (word, n): a character is coded by its code point, plus ``INNER`` inside the word."""
    def code(batches):
        for batch in batches:
            column = batch.column(0)
            sizes = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.int32) + np.int32(INNER)
            codes[(np.cumsum(sizes) - sizes)[sizes > 0]] -= INNER
            yield pa.RecordBatch.from_arrays([packed(codes, sizes), batch.column(1)], ["syms", "n"])

    return words.select("word", "n").mapInArrow(code, "syms binary, n bigint")


def coded_name(code: int) -> str:
    return chr(code) if code < INNER else CONT + chr(code - INNER)


def symbol_counts(words: DataFrame) -> DataFrame:
    """(code, n): how often each symbol occurs."""
    def count(batches):
        for codes, sizes, n in _chunks(batches):
            found, at = np.unique(codes, return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, at, np.repeat(n, sizes))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total)], ["code", "n"])

    return words.mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def _runs(keys: np.ndarray) -> tuple:
    """(order, starts): a stable order of ``keys`` and where each value begins in it."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _pair_keys(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """left << 32 | right at each symbol but the last; -1 across words."""
    keys = (codes[:-1].astype(np.int64) << 32) | codes[1:]
    keys[np.cumsum(sizes)[:-1] - 1] = -1
    return keys


def coded_pairs(words: DataFrame) -> DataFrame:
    """(left, right, n): how often each pair of adjacent codes occurs.  Words have two symbols at least."""
    def count(batches):
        for codes, sizes, n in _chunks(batches):
            keys = _pair_keys(codes, sizes)
            inside = keys >= 0
            keys, n = keys[inside], np.repeat(n, sizes)[:-1][inside]
            order, starts = _runs(keys)
            found = keys[order[starts]]
            yield pa.RecordBatch.from_arrays([
                pa.array((found >> 32).astype(np.int32)), pa.array((found & 0xFFFFFFFF).astype(np.int32)),
                pa.array(np.add.reduceat(n[order], starts))], ["left", "right", "n"])

    return words.mapInArrow(count, _COUNTED).groupBy("left", "right").agg(F.sum("n").alias("n"))


def cut_words(words: DataFrame, known: np.ndarray) -> DataFrame:
    """(syms, n): the different pieces of all words between pairs that are not in ``known`` (sorted keys), and
    how often each occurs.  Pieces of one symbol are left out."""
    shared = words.sparkSession.sparkContext.broadcast(known)

    def cut(batches):
        known = shared.value
        for codes, sizes, n in _chunks(batches):
            keys = _pair_keys(codes, sizes)
            hit = np.zeros(len(codes) + 1, bool)            # whether a symbol holds on to the one before it
            hit[1:-1] = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys
            first = hit[1:] & ~hit[:-1]
            inside = hit[1:] | hit[:-1]
            kept = codes[inside]
            if not len(kept):
                continue
            starts = np.flatnonzero(first[inside])
            n = np.repeat(n, sizes)[inside][starts]
            pieces = pa.table({"syms": packed(kept, np.diff(np.append(starts, len(kept)))), "n": n})
            for batch in pieces.group_by("syms").aggregate([("n", "sum")]).select(["syms", "n_sum"]).rename_columns(
                    ["syms", "n"]).to_batches():
                yield batch

    return words.mapInArrow(cut, "syms binary, n bigint").groupBy("syms").agg(F.sum("n").alias("n"))


# ----------------------------------------------------------------- merges
def merge_pieces(codes: np.ndarray, sizes: np.ndarray, n: np.ndarray, names: dict, first: int, floor: int, room: int,
                 taken: set) -> list:
    """The next merges (left, right) while the best pair counts ``floor`` at least; merge ``i`` makes code ``first + i``.

    ``names`` (code -> symbol) and ``taken`` are extended.  The symbols are linked chains; places
    of a pair are found once, when the later of its two symbols is made: from then on they only get fewer, so
    its count is looked up again only when it is the highest.  Pairs made below the floor are never looked at.
    """
    # A symbol that ends every chain stands before the first, between two, and after the last.
    sym = np.full(len(codes) + len(sizes) + 1, _END, np.int32)
    at = np.arange(len(codes)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    sym[at] = codes
    weight = np.zeros(len(sym), np.int64)
    weight[at] = np.repeat(n, sizes)
    after, before = np.arange(1, len(sym) + 1, dtype=np.int32), np.arange(-1, len(sym) - 1, dtype=np.int32)
    del at
    heap, places, out = [], {}, []

    def add(symbols, where, make):
        """Note the pairs ``make(symbol)`` at ``where``, those that count enough."""
        if not len(symbols):
            return
        order, starts = _runs(symbols)
        total = np.add.reduceat(weight[where[order]], starts)
        much = np.flatnonzero(total >= floor)
        if not len(much):
            return
        ends = np.append(starts[1:], len(order))
        for s, i, j, t in zip(symbols[order[starts[much]]].tolist(), starts[much].tolist(), ends[much].tolist(), total[much].tolist()):
            left, right = make(s)
            places[left, right] = where[order[i:j]]
            heapq.heappush(heap, (-t, names[left], names[right], left, right))

    pairs = np.flatnonzero((sym[:-1] >= 0) & (sym[1:] >= 0)).astype(np.int32)
    add((sym[pairs].astype(np.int64) << 32) | sym[pairs + 1], pairs, lambda key: (key >> 32, key & 0xFFFFFFFF))
    del pairs
    while heap and len(out) < room:
        count, left_name, right_name, left, right = heapq.heappop(heap)
        where = places.pop((left, right))
        where = where[(sym[where] == left) & (sym[after[where]] == right)]
        total = int(weight[where].sum())
        if total != -count:
            if total >= floor:
                places[left, right] = where
                heapq.heappush(heap, (-total, left_name, right_name, left, right))
            continue
        token = merged_token(left_name, right_name)
        if token in taken:
            continue
        taken.add(token)
        code = first + len(out)
        names[code] = token
        out.append((left, right))
        if left == right:
            where = where[_every_second(after[where[:-1]] == where[1:])]
        gone = after[where]
        follow = after[gone]
        sym[where], sym[gone], after[where], before[follow] = code, _GONE, follow, where
        follow, lead = sym[follow], before[where]
        ahead = sym[lead]
        use = follow >= 0
        add(follow[use], where[use], lambda s: (code, s))
        use = (ahead >= 0) & (ahead != code)
        add(ahead[use], lead[use], lambda s: (s, code))
    return out


def _every_second(joined: np.ndarray) -> np.ndarray:
    """Of places in order, where ``joined[i]`` says that place i + 1 overlaps place i: those that are merged from the left."""
    i = np.arange(len(joined) + 1)
    start = np.concatenate([[True], ~joined])
    return (i - np.maximum.accumulate(np.where(start, i, 0))) % 2 == 0


def merge_word(symbols: list, rank: dict, first: int) -> list:
    """All merges of ``rank`` (pair -> order) applied to one word, in their order."""
    symbols, after, before = list(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    heap = [(rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = after[i]
        if symbols[i] is None or j >= len(symbols) or rank.get((symbols[i], symbols[j])) != r:
            continue
        k = after[i] = after[j]
        symbols[i], symbols[j] = first + r, None
        if k < len(symbols):
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < len(symbols) and (symbols[a], symbols[b]) in rank:
                heapq.heappush(heap, (rank[symbols[a], symbols[b]], a))
    return [s for s in symbols if s is not None]


def merge_words(codes: np.ndarray, sizes: np.ndarray, keys: np.ndarray, order: np.ndarray, first: int) -> tuple:
    """(codes, sizes) after merges given as sorted pair ``keys`` and the ``order`` of each.

    In every step each word has all places of its first merge replaced; a merge makes only pairs that come later.
    """
    def ranks(left, right):
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, order[at], _NONE)

    out, alive = codes.copy(), np.ones(len(codes), bool)
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    rank = np.full(len(codes), _NONE, np.int32)
    rank[:-1] = np.where(word[1:] == word[:-1], ranks(codes[:-1], codes[1:]), _NONE)
    long = np.flatnonzero(sizes > LONG)
    if len(long):
        table = {(k >> 32, k & 0xFFFFFFFF): r for k, r in zip(keys.tolist(), order.tolist())}
        for i in long.tolist():
            at, end = starts[i], starts[i] + sizes[i]
            new = merge_word(codes[at:end].tolist(), table, first)
            out[at:at + len(new)] = new
            alive[at + len(new):end] = False
            rank[at:end] = _NONE
    place = np.arange(len(codes), dtype=np.int64)
    sym = codes.copy()
    while len(sym):
        begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best, size = np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(word)))
        left = best < _NONE
        if not left.all():
            keep = np.repeat(left, size)
            sym, word, rank, place, best, size = sym[keep], word[keep], rank[keep], place[keep], best[left], size[left]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == np.repeat(best, size))
        hit = hit[_every_second(hit[1:] == hit[:-1] + 1)]
        sym[hit] = rank[hit] + first
        out[place[hit]] = sym[hit]
        alive[place[hit + 1]] = False
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        sym, word, rank, place = sym[keep], word[keep], rank[keep], place[keep]
        hit -= np.arange(len(hit))                      # where the tokens are among the symbols kept
        rank[hit] = _NONE
        for i in (hit - 1, hit):
            i = i[(i >= 0) & (i + 1 < len(sym))]
            rank[i] = np.where(word[i] == word[i + 1], ranks(sym[i], sym[i + 1]), _NONE)
    return out[alive], np.add.reduceat(alive, starts, dtype=np.int64) if len(sizes) else sizes


def rewritten(words: DataFrame, merges: list, first: int) -> DataFrame:
    """The words after ``merges`` (left, right), those that have two symbols or more."""
    pairs = np.array(merges, np.int64)
    keys = (pairs[:, 0] << 32) | pairs[:, 1]
    order = np.argsort(keys)
    shared = words.sparkSession.sparkContext.broadcast((keys[order], order.astype(np.int32)))

    def rewrite(batches):
        for codes, sizes, n in _chunks(batches):
            codes, sizes = merge_words(codes, sizes, *shared.value, first)
            use = sizes > 1
            yield pa.RecordBatch.from_arrays([packed(codes[np.repeat(use, sizes)], sizes[use]), pa.array(n[use])], ["syms", "n"])

    return words.mapInArrow(rewrite, "syms binary, n bigint")


def _symbols(words: DataFrame) -> int:
    return (words.agg(F.sum(F.length("syms"))).first()[0] or 0) // 4


def _levels(pairs: DataFrame) -> list:
    """(count, pairs) from the highest count down; from 4096 up, counts within 1 % are one level with its lowest count."""
    level = F.when(F.col("n") < 4096, F.col("n").cast("double")).otherwise(4096 + F.floor(F.log2(F.col("n") / 4096.0) * 64))
    rows = pairs.groupBy(level.alias("level")).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("pairs")).collect()
    return sorted(((r.n, r.pairs) for r in rows), reverse=True)


def coded_merges(words: DataFrame, names: dict, room: int, taken: set, min_count: int = 2,
                 working_symbols: int | None = None, look: int | None = None) -> list:
    """The first ``room`` merges (left, right) of stored coded ``words``, exactly as merging one
    pair at a time would choose them.  ``names`` (code -> symbol) and ``taken`` (tokens that exist) are extended."""
    working = WORKING_SYMBOLS if working_symbols is None else working_symbols
    look = LOOK if look is None else look
    words = words.where(F.length("syms") > 4)
    out, m, code = [], min(FIRST, look), max(names, default=0) + 1
    while len(out) < room:
        if _symbols(words) <= working:
            merges = _merged_at_driver(words, names, code, min_count, room - len(out), taken)
            return out + [(names[a], names[b]) for a, b in merges]
        pairs = stage(coded_pairs(words).where(F.col("n") >= min_count), "pairs")
        levels, merges = _levels(pairs), []
        while levels and levels[0][1] <= look:
            floor, found = levels[0]
            for n, more in levels[1:]:
                if found + more > m:
                    break
                floor, found = n, found + more
            known = pairs.where(F.col("n") >= floor).select("left", "right").toArrow()
            known = np.sort((known["left"].to_numpy().astype(np.int64) << 32) | known["right"].to_numpy())
            pieces = stage(cut_words(words, known), "pieces")
            size = _symbols(pieces)
            if size <= working:
                merges = _merged_at_driver(pieces, names, code, floor, room - len(out), taken)
                # As many pairs as should fit the next time.
                m = min(look, found * (8 if size * 2 <= working else 4))
                break
            if floor == levels[0][0]:
                break
            m = found // 4
        if not merges:
            merges = _merged_among_ties(words, pairs, names, code, room - len(out), taken, min_count, min(working, TIED_SYMBOLS), min(look, TIED))
        if not merges:
            break
        out += [(names[a], names[b]) for a, b in merges]
        if len(out) < room:
            words = stage(rewritten(words, merges, code), "words")
        code += len(merges)
    return out


def _merged_at_driver(pieces: DataFrame, names: dict, first: int, floor: int, room: int, taken: set) -> list:
    table = pieces.select("syms", "n").toArrow().combine_chunks()
    if not table.num_rows:
        return []
    codes, sizes = unpacked(table.column("syms").chunk(0))
    n = table.column("n").to_numpy()
    del table
    return merge_pieces(codes, sizes, n, names, first, floor, room, taken)


def _merged_among_ties(words: DataFrame, pairs: DataFrame, names: dict, first: int, room: int, taken: set, min_count: int,
                       working: int, look: int) -> list:
    """Merges of the first pairs by rank, from the stretches around them; where these are too many, the very first pair."""
    shared = words.sparkSession.sparkContext.broadcast((names, taken))

    def named(batches):
        names, taken = shared.value
        for batch in batches:
            rows = [(names[a], names[b], n) for a, b, n in zip(*(c.to_pylist() for c in batch.columns))]
            rows = [r for r in rows if merged_token(r[0], r[1]) not in taken]
            yield pa.RecordBatch.from_pylist([{"left": a, "right": b, "n": n} for a, b, n in rows], pa.schema(
                [("left", pa.string()), ("right", pa.string()), ("n", pa.int64())]))

    def listed(batches):
        for batch in batches:
            codes, sizes = unpacked(batch.column(0))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(codes)), batch.column(1)], ["syms", "n"])

    top = (pairs.mapInArrow(named, "left string, right string, n bigint")
           .orderBy(F.desc("n"), "left", "right").limit(look + 1).collect())
    if not top:
        return []
    last = top[look] if len(top) > look else None            # only a floor, unless these are all pairs
    known = {(r.left, r.right): r.n for r in top[:max(look, 1)]}
    codes = {name: code for code, name in names.items()}
    held = stage(_cut(words.mapInArrow(listed, "syms array<int>, n bigint"), {(codes[a], codes[b]) for a, b in known}), "stretches")
    merges = [(top[0].left, top[0].right)]
    if (held.agg(F.sum(F.size("syms"))).first()[0] or 0) <= working:
        merges = merge_in_working_set([([names[s] for s in r.syms], r.n) for r in held.collect()], known, last and (
            -last.n, last.left, last.right), room, set(taken), min_count)
    out = []
    for i, (a, b) in enumerate(merges):
        out.append((codes[a], codes[b]))
        token = merged_token(a, b)
        names[first + i], codes[token] = token, first + i
        taken.add(token)
    return out


def sequential_merges(words: DataFrame, room: int, taken: set, min_count: int = 2,
                      working_symbols: int | None = None, look: int | None = None) -> list:
    """``coded_merges`` of ``words`` (syms array<string>, n), whatever their symbols."""
    found = sorted(r.s for r in words.select(F.explode("syms").alias("s")).distinct().collect())
    codes = {s: i for i, s in enumerate(found)}
    shared = words.sparkSession.sparkContext.broadcast(codes)

    def code(batches):
        for batch in batches:
            lists = batch.column(0)
            symbols = lists.flatten().dictionary_encode()
            at = np.array([shared.value[s] for s in symbols.dictionary.to_pylist()], np.int32)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([packed(at[symbols.indices.to_numpy()], sizes), batch.column(1)], ["syms", "n"])

    coded = words.where(F.size("syms") > 1).select("syms", F.col("n").cast("bigint").alias("n")).mapInArrow(code, "syms binary, n bigint")
    return coded_merges(stage(coded, "words"), dict(enumerate(found)), room, taken, min_count, working_symbols, look)


# ----------------------------------------------------------------- ties
def stretches(symbols: list, known) -> list:
    """The parts of a word whose symbols are in a pair of ``known``, each with the symbol before and after it."""
    out, start, n = [], None, len(symbols)
    hit = [p in known for p in zip(symbols, symbols[1:])]
    if True not in hit:
        return out
    for i in range(n + 1):
        inside = i < n and (i < n - 1 and hit[i] or i > 0 and hit[i - 1])
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append(symbols[max(start - 1, 0):i + 1])
            start = None
    return out


def _cut(words: DataFrame, known) -> DataFrame:
    """(syms, n): the different stretches of all words and how often each occurs."""
    kind = words.schema["syms"].dataType.elementType.simpleString()
    symbol = pa.int32() if kind == "int" else pa.string()
    known = words.sparkSession.sparkContext.broadcast(set(known))

    def cut(batches):
        for batch in batches:
            parts, sums = {}, known.value
            for s, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in stretches(s, sums):
                    part = tuple(part)
                    parts[part] = parts.get(part, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in parts], pa.list_(symbol)),
                                              pa.array(list(parts.values()), pa.int64())], ["syms", "n"])

    return words.select("syms", "n").mapInArrow(cut, f"syms array<{kind}>, n bigint").groupBy("syms").agg(F.sum("n").alias("n"))


def _replace(symbols: list, pair: tuple, token: str) -> list:
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
            out.append(token)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def merge_in_working_set(words: list, known: dict, floor: tuple | None, room: int, taken: set,
                         min_count: int) -> list:
    """The next merges, from the stretches (or whole words) that hold the ``known`` pairs (pair -> count).

    Stops before the best pair would rank at or below ``floor`` (-count, left, right), or
    joins symbols that were not a known pair: one of them may be the end of a stretch.
    """
    ends = {}                               # made token -> its first and last symbol as of the start
    count, where, out = dict(known), {p: set() for p in known}, []
    words = [list(s) for s, _ in words], [n for _, n in words]
    for i, s in enumerate(words[0]):
        for p in zip(s, s[1:]):
            if p in where:
                where[p].add(i)
    heap = [(-n, *p) for p, n in count.items()]
    heapq.heapify(heap)
    while heap and len(out) < room:
        n, *p = heapq.heappop(heap)
        p = tuple(p)
        if count.get(p) != -n:
            continue                        # an older entry of this pair
        if -n < min_count or (floor is not None and (n, *p) >= floor):
            break
        token = merged_token(*p)
        if token in taken:
            continue
        left, right = ends.get(p[0], (p[0], p[0])), ends.get(p[1], (p[1], p[1]))
        if (left[1], right[0]) not in known:
            break
        ends[token] = (left[0], right[1])
        taken.add(token)
        out.append(p)
        changed = {}
        for i in where[p]:
            old = words[0][i]
            new = words[0][i] = _replace(old, p, token)
            for sign, s in ((-1, old), (1, new)):
                for q in zip(s, s[1:]):
                    if q in count or token in q:
                        changed[q] = changed.get(q, 0) + sign * words[1][i]
                        if sign > 0:
                            where.setdefault(q, set()).add(i)
        for q, d in changed.items():
            if d:
                count[q] = count.get(q, 0) + d
                heapq.heappush(heap, (-count[q], *q))
    return out
