"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, capitalised names and units turn into
typed placeholders (NUM, NAME, UNIT), other words are lower-cased and lose
their outer punctuation.  Windows of ``WINDOW`` template tokens are
hash-joined between benchmark items and documents; for each joined pair of
windows the slots are checked for consistency: equal slot values on one side
must be equal on the other (a one-to-one renaming).  A copied question and
one with other numbers, names or units are both caught; words that merely
share a shape are not.  A figure with an attached unit ("120km") counts as the
two tokens it holds.  Item windows are also hashed with their names in lower
case, which is how names look in a lower-case or shouted copy.

An item shorter than a window is one window of its own length; one of fewer
than ``MIN_CONTAINED`` tokens matches only a document that holds nothing else.  Windows with
fewer than ``MIN_LITERALS`` literal tokens carry no template: they match only
with the same slot values (an exact copy), which are part of their hash.

The benchmark side is broadcast while its windows number at most
``MAX_BROADCAST`` (checked by a count); beyond that the documents' windows are
shuffled and joined by hash.  Both ways give the same rows.

Defined results: null or blank texts match nothing; repeated rows and items
each match on their own; empty tables give an empty result; extra columns are
ignored.  Long texts are read whole, window by window.
"""

from __future__ import annotations

import copy
import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
MIN_LITERALS = 4
MIN_CONTAINED = 3
MAX_BROADCAST = 200_000
# Bytes of window hashes that may go with a task when the windows themselves are too many.
HASH_BYTES = 128 << 20
# Bytes of text whose words are cut and looked up together.
PART_BYTES = 2 << 20

NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
# Unit words.
UNITS = frozenset("""mm cm m km in ft yd mi mg g kg t oz lb ml l gal s sec min h hr hrs ms ns hz khz mhz ghz
    kb mb gb tb w kw mw v kv a ma j kj cal kcal pa kpa bar k c f % $ usd eur gbp euro euros dollar dollars cent
    cents meter meters metre metres kilometer kilometers mile miles inch inches foot feet yard yards gram grams
    kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes hour
    hours day days week weeks month months year years percent degree degrees""".split())
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?$", re.IGNORECASE)
_WITH_UNIT = re.compile(r"([+-]?\d[\d.,:/]*)([a-z]+)$", re.IGNORECASE)
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&"


def ends_sentence(word: str) -> bool:
    return not set(".!?").isdisjoint(word[len(word.rstrip(_EDGES)):])


def template_token(word: str) -> tuple:
    """(literal or placeholder, slot value or None, may be a name, ends a sentence)."""
    core = word.strip(_EDGES)
    ends = ends_sentence(word)
    if not core:
        return (UNIT, word, False, ends) if word in ("%", "$") else (word, None, False, ends)
    if _NUMBER.match(core):
        return NUM, core.lower(), False, ends
    if core.lower() in UNITS:
        return UNIT, core.lower(), False, ends
    # Capitalised, not all capitals: shouted text is lower-cased like any other.
    return core.lower(), None, core[0].isupper() and core[1:] != core[1:].upper(), ends


def with_unit(word: str) -> tuple | None:
    """(figure, unit) of a word like "120km"."""
    m = _WITH_UNIT.match(word.strip(_EDGES))
    return m.groups() if m and not _NUMBER.match(m[0]) and m[2].lower() in UNITS else None


class _Coder(dict):
    """word -> row of ``table``: literal, slot, name slot, ends a sentence, attached unit's
    slot, literal of a unit word.

    Codes are 64-bit hashes; slot 0 means "no slot".  The word cache is
    emptied at ``LIMIT`` words, so memory stays bounded on any corpus.
    """

    LIMIT = 400_000

    def __init__(self):
        self.table = np.zeros((1024, 6), np.uint64)
        # Of words not in the table yet: their literals, and whole rows where more is set.
        self.literals, self.others = array("Q"), []

    def __missing__(self, word):
        text = word.decode("utf-8", "replace")
        n = self[word] = len(self)
        core = text.strip(_EDGES)
        if core.isalpha() and (low := core.lower()) not in UNITS:
            # Most words: no figure and no unit.  The same row as below.
            literal = xxhash.xxh64_intdigest(low)
            name = core[0].isupper() and core[1:] != core[1:].upper()
            ends = len(core) < len(text) and ends_sentence(text)
            self.literals.append(literal)
            if name or ends:
                self.others.append((n, (literal, 0, xxhash.xxh64_intdigest(core) | 1 if name else 0, ends, 0, 0)))
            return n
        parts = with_unit(text)
        token, slot, name, ends = template_token(parts[0] if parts else text)
        if parts:
            ends = template_token(text)[3]
        literal = xxhash.xxh64_intdigest(token)
        self.literals.append(literal)
        self.others.append((n, (literal, 0 if slot is None else xxhash.xxh64_intdigest(slot) | 1,
                                xxhash.xxh64_intdigest(core) | 1 if name else 0, ends,
                                xxhash.xxh64_intdigest(parts[1].lower()) | 1 if parts else 0,
                                xxhash.xxh64_intdigest(core.lower()) if token == UNIT else 0)))
        return n

    def rows(self, words: list) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        known = len(self)
        index = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if len(self) > known:
            self._fill(known)
        return self.table[index]

    def texts(self, column: pa.Array):
        """The rows of the words of each text, null ones included.

        Some megabytes of text are cut at a time ([\x20\x09-\x0D] in Arrow, as in
        ``bytes.split``), and each different word in them is looked up once.
        """
        if not len(column):
            return
        column = column.cast(pa.large_string()).fill_null("")
        upto = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) // PART_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), len(column)]
        for lo, hi in zip(cuts, cuts[1:]):
            lists = pc.ascii_split_whitespace(column.slice(lo, hi - lo))
            words = lists.flatten().dictionary_encode()
            distinct = words.dictionary.cast(pa.large_binary()).to_pylist()
            rows, index = self.rows(distinct), words.indices.to_numpy()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            if b"" in distinct:             # white space at an end of a text
                full = index != distinct.index(b"")
                ends = np.concatenate([[0], np.cumsum(full)])[ends]
                index = index[full]
            yield from np.split(rows[index], ends[:-1])

    def _fill(self, known: int):
        """Put the new words into the table at once."""
        n = len(self)
        if n > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((max(n, len(self.table)), 6), np.uint64)])
        self.table[known:n] = 0
        self.table[known:n, 0] = self.literals
        if self.others:
            at, rows = zip(*self.others)
            self.table[list(at)] = np.array(rows, np.uint64)
        self.literals, self.others = array("Q"), []


_P = np.uint64(0x9E3779B97F4A7C15)


_NUM_CODE, _NAME_CODE, _UNIT_CODE = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (NUM, NAME, UNIT))
_CURRENCY = np.array([xxhash.xxh64_intdigest(x) | 1 for x in ("$", "usd", "eur", "gbp", "euro", "euros")], np.uint64)


class Encoded:
    """Template tokens and slots of a text.

    A unit word is a unit only after a figure (a currency before one too); elsewhere ("a",
    "in", "day") it is a word like others.  So it is at the start of a window.

    A capitalised word that does not start a sentence is a name.  The first
    word of a window has no context, so windows come in two variants: with
    their first word as a literal and, if capitalised, as a name.
    """

    def __init__(self, t: np.ndarray):
        """``t``: rows of the words (``_Coder``), which may be written over."""
        self.word = np.arange(len(t))  # the word that holds a token
        if t[:, 4].any():
            split = t[:, 4] != 0
            self.word = np.repeat(self.word, 1 + split)
            unit = np.flatnonzero(np.diff(self.word, prepend=-1) == 0)
            t = t[self.word]
            t[unit, 0], t[unit, 1], t[unit - 1, 3] = _UNIT_CODE, t[unit, 4], 0
        # Only the unit words are looked at, and their neighbours.
        unit = np.flatnonzero((t[:, 0] == _UNIT_CODE) & (t[:, 5] != 0))
        if len(unit):
            own = t[unit, 5]
            plain = unit[(unit == 0) | (t[unit - 1, 0] != _NUM_CODE)]
            after = np.minimum(plain + 1, len(t) - 1)
            plain = plain[~((plain < after) & (t[after, 0] == _NUM_CODE) & np.isin(t[plain, 1], _CURRENCY))]
            t[plain, 0], t[plain, 1] = t[plain, 5], 0
        self.n = len(t)
        self.literal, self.slot, self.name_slot = t[:, 0], t[:, 1], t[:, 2]
        self.head, self.head_slot = self.literal, self.slot  # of the first word of a window
        if len(unit):
            self.head, self.head_slot = self.literal.copy(), self.slot.copy()
            self.head[unit], self.head_slot[unit] = own, 0
        named = (self.name_slot != 0) & np.concatenate([[False], t[:-1, 3] == 0])[:self.n]
        self.tokens = np.where(named, _NAME_CODE, self.literal)
        self.slots = np.where(named, self.name_slot, self.slot)

    def lowered(self) -> Encoded:
        """The same text with its names as lower-case literals."""
        e = copy.copy(self)
        e.tokens, e.slots, e.name_slot = self.literal, self.slot, np.zeros_like(self.name_slot)
        return e

    def window_slots(self, i: int, size: int, as_name: bool) -> np.ndarray:
        s = self.slots[i:i + size].copy()
        s[0] = self.name_slot[i] if as_name else self.head_slot[i]
        return s

    def hashes(self, size: int):
        """(hashes, start tokens, first-is-name) of all windows, both variants.

        The hash of a window with few literals covers its slot values too.
        """
        n = self.n - size + 1
        if n <= 0 or size <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
        cap = np.flatnonzero(self.name_slot[:n] != 0)
        start = np.concatenate([np.arange(n), cap])
        as_name = np.arange(len(start)) >= n
        h = np.concatenate([self.head[:n], np.full(len(cap), _NAME_CODE)])
        with np.errstate(over="ignore"):
            h = (h ^ np.uint64(size)) * _P
            for i in range(1, size):
                h ^= h >> np.uint64(29)
                part = self.tokens[i:i + n]
                h = (h ^ np.concatenate([part, part[cap]])) * _P
            h ^= h >> np.uint64(32)
            first = np.concatenate([self.head_slot[:n], self.name_slot[cap]])
            until = np.concatenate([[0], np.cumsum(self.slots == 0)])
            few = np.flatnonzero(until[start + size] - until[start + 1] + (first == 0) < min(MIN_LITERALS, size))
            if len(few):
                x, at = (h[few] ^ first[few]) * _P, start[few]
                for i in range(1, size):
                    x ^= x >> np.uint64(29)
                    x = (x ^ self.slots[at + i]) * _P
                h[few] = x ^ (x >> np.uint64(32))
        return h, start, as_name


def consistent(a: np.ndarray, b: np.ndarray) -> bool:
    """Slots of two windows of one template rename one-to-one."""
    there, back = {}, {}
    for x, y in zip(a.tolist(), b.tolist()):
        if x and (there.setdefault(x, y) != y or back.setdefault(y, x) != x):
            return False
    return True


def same_passage(a: np.ndarray, b: np.ndarray) -> bool:
    """Slots of two joined windows agree: renamed, or equal where literals are few."""
    if np.count_nonzero(a == 0) < min(MIN_LITERALS, len(a)):
        return np.array_equal(a, b)
    return consistent(a, b)


WINDOWS_SCHEMA = "item_id long, size int, hash long, slots binary"
# Arrow, not pandas: a null beside a large id would turn ids into floats.
WINDOWS = pa.schema([("item_id", pa.int64()), ("size", pa.int32()), ("hash", pa.int64()), ("slots", pa.binary())])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Template windows of the benchmark: item_id, size, hash, slots."""
    src = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))

    def run(batches):
        coder = _Coder()
        for batch in batches:
            out = []
            for item, rows in zip(batch.column(0).to_pylist(), coder.texts(batch.column(1))):
                e = Encoded(rows)
                size = min(window, e.n)
                for x in (e, e.lowered()) if e.name_slot.any() else (e,):
                    for h, i, as_name in zip(*x.hashes(size)):
                        out.append((item, size, int(h.astype(np.int64)), x.window_slots(i, size, as_name).tobytes()))
            yield _batch(out, WINDOWS)

    return src.mapInArrow(run, WINDOWS_SCHEMA).distinct()


class _Lookup:
    """Benchmark windows in a task: sorted hashes per size, then items."""

    def __init__(self, rows: list):
        self.items, keys = {}, {}
        for item, size, h, slots in rows:
            h &= 0xFFFFFFFFFFFFFFFF
            self.items.setdefault((size, h), []).append((item, np.frombuffer(slots, np.uint64)))
            keys.setdefault(size, set()).add(h)
        self.known = {s: np.sort(np.array(list(k), dtype=np.uint64)) for s, k in keys.items()}

    def hits(self, e: Encoded) -> dict:
        """item -> first and end words of its matching windows."""
        found = {}
        for size, known in self.known.items():
            if size < MIN_CONTAINED and size != e.n:
                continue
            h, start, as_name = e.hashes(size)
            if not len(h):
                continue
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for j in np.flatnonzero(known[at] == h).tolist():
                i = int(start[j])
                mine = e.window_slots(i, size, bool(as_name[j]))
                for item, slots in self.items[(size, int(h[j]))]:
                    if same_passage(slots, mine):
                        ends = found.setdefault(item, {})
                        first, end = int(e.word[i]), int(e.word[i + size - 1]) + 1
                        ends[first] = max(end, ends.get(first, 0))
        return found


HITS_SCHEMA = "doc_id long, item_id long, n_windows long, first_word long, end_word long"
HITS = pa.schema([(name, pa.int64()) for name in ("doc_id", "item_id", "n_windows", "first_word", "end_word")])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 window: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Matched (document, item) pairs: doc_id, item_id, n_windows, first_word, end_word."""
    wins = item_windows(items, window=window)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # A window is at most 8 bytes a word and a few numbers, so a count bounds its bytes.
    few = wins.limit(max_broadcast + 1).count() <= max_broadcast
    if not few:
        return _shuffled(src, wins)
    shared = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in wins.collect()])

    def run(batches):
        lookup, coder = _Lookup(shared.value), _Coder()
        for batch in batches:
            out = [(doc, item, len(w), min(w), max(w.values()))
                   for doc, rows in zip(batch.column(0).to_pylist(), coder.texts(batch.column(1)))
                   for item, w in lookup.hits(Encoded(rows)).items()]
            yield _batch(out, HITS)

    return src.mapInArrow(run, HITS_SCHEMA)


def _shuffled(src: DataFrame, wins: DataFrame) -> DataFrame:
    """The same pairs with the benchmark's windows too many for a task.

    The sorted 64-bit hashes alone (8 bytes a window) go with the task while they are
    within ``HASH_BYTES``, so only windows that some item has are shuffled; beyond it all are.
    """
    sizes = [r["size"] for r in wins.select("size").distinct().collect()]  # at most WINDOW values
    n = wins.select("hash").distinct().count()
    known = None
    if 8 * n <= HASH_BYTES:
        h = wins.select("hash").distinct().toArrow()["hash"].to_numpy()
        known = src.sparkSession.sparkContext.broadcast(np.sort(h.view(np.uint64)).tobytes())

    def explode(batches):
        coder = _Coder()
        hashes = None if known is None else np.frombuffer(known.value, np.uint64)
        for batch in batches:
            for row, doc, rows in zip(*(c.to_pylist() for c in batch.columns[:2]), coder.texts(batch.column(2))):
                e = Encoded(rows)
                for s in sizes:
                    if s < MIN_CONTAINED and s != e.n:
                        continue
                    h, start, as_name = e.hashes(s)
                    if hashes is not None and len(h):
                        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                        met = hashes[at] == h
                        h, start, as_name = h[met], start[met], as_name[met]
                    for lo in range(0, len(h), 4096):
                        part = slice(lo, lo + 4096)
                        k = len(h[part])
                        yield pa.RecordBatch.from_arrays([
                            pa.array([row] * k, pa.int64()), pa.array([doc] * k, pa.int64()), pa.array([s] * k, pa.int32()),
                            pa.array(h[part].astype(np.int64)), pa.array(e.word[start[part]]),
                            pa.array(e.word[start[part] + s - 1] + 1),
                            pa.array([e.window_slots(i, s, a).tobytes() for i, a in zip(start[part], as_name[part])], pa.binary())],
                            names=["row", "doc_id", "size", "hash", "word", "end", "doc_slots"])

    doc_wins = (src.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
                .mapInArrow(explode, "row long, doc_id long, size int, hash long, word long, end long, doc_slots binary"))

    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_passage(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)])

    hits = doc_wins.join(wins, ["size", "hash"]).filter(same("slots", "doc_slots"))
    return (hits.groupBy("row", "doc_id", "item_id")
            .agg(F.countDistinct("word").alias("n_windows"), F.min("word").alias("first_word"),
                 F.max("end").alias("end_word")).drop("row"))
