"""Repeated passages by sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words; words covered by a window whose
sequence also starts elsewhere are removed.

1. One scan hashes the words of each text and picks the anchor of each window:
   its leftmost least ``GRAM``-word hash.  Equal windows have equal anchors, so
   an anchor that starts at one place only rules its windows out; about one
   word in 13 is an anchor.  Texts with equal words form a class; each
   window of a class of several recurs, and copies go no further.
2. Anchors that start at two places or more send their surroundings (the words
   of the windows they anchor, 60 or, where the text is periodic, more) to the
   shard of the anchor.
3. A shard confirms recurring windows by counting them, compiles the
   passages they make up into an Aho-Corasick automaton (pyahocorasick), and
   streams the surroundings through it to locate every occurrence.  A shard
   builds one automaton per ``SHARD`` surroundings, which bounds its memory.
   Anchors with more than ``HOT`` places are confirmed before that, in blocks of window
   hashes instead of rows: a task first drops the windows that recur
   within its batch, buckets of hashes then find the windows that
   occur once, and these go back to the rows that hold them; all others recur.  Such
   surroundings are dealt over salted shards, so no task needs a whole hot group.
4. The located spans go back to the texts of the affected documents.

Texts without any recurring anchor are settled by the first scan.

Defined results: null and blank texts have no words; texts below ``WINDOW``
words lose none; repeated rows are copies of each other; ties and null ids are
rows like others; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach_groups, materialize
from corpusmill.llm.words import column_bytes, runs, words_of

WINDOW = 35
GRAM = 10
SPREAD = WINDOW - GRAM + 1  # grams in a window
HOT = 2048
SHARD = 2048
SALTS = 64


def class_of(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), len(hashes)) - (1 << 63)


def anchors_of(hashes: np.ndarray):
    """(gram hashes, anchor position of each window) of a text's words."""
    if len(hashes) < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    g = runs(hashes, GRAM)
    value, at = g, np.arange(len(g))

    def least(v, p, step):
        later = v[step:] < v[:-step]
        return np.where(later, v[step:], v[:-step]), np.where(later, p[step:], p[:-step])

    width = 1
    while 2 * width <= SPREAD:
        value, at = least(value, at, width)
        width *= 2
    if width < SPREAD:
        value, at = least(value, at, SPREAD - width)
    return g, at


def anchor_runs(g: np.ndarray, at: np.ndarray):
    """(first window, end window) of runs of windows with one anchor hash.

    In periodic texts neighbouring windows have equal anchors at different
    places; such a run is one surrounding, however long the text repeats.
    """
    if not len(at):
        return at, at
    value = g[at]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    return first, np.append(first[1:], len(at))


def joined_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]


def _digest(words: list) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


SCAN = "doc_id long, key long, n_words long, cls long, sha256 string, anchors array<long>, places array<int>"


def _scan(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("cls", pa.int64()), ("sha256", pa.string()),
                        ("anchors", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])
    done = set()
    for batch in batches:
        n, cls, sha, anchors, places = [], [], [], [], []
        for data in column_bytes(batch.column(2)):
            s, e, h = words_of(data)
            c = class_of(h)
            g, at = anchors_of(h)
            # A run names its first place, and its last if it has several.
            a, b = anchor_runs(g, at)
            # A copy that this task has seen before brings no new place.
            at = np.unique(np.concatenate([at[a], at[b - 1]])) if c not in done else at[:0]
            done.add(c)
            n.append(len(h))
            cls.append(c)
            sha.append(_digest(joined_words(data, s, e)))
            anchors.append(g[at].view(np.int64))
            places.append(at.astype(np.int32))
        if len(done) > 1_000_000:
            done.clear()
        ends = np.cumsum([0] + [len(a) for a in anchors]).astype(np.int32)
        flat = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((anchors, np.int64), (places, np.int32))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(sha, pa.string()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[0])), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[1]))],
            schema=schema)


SURROUNDINGS = "anchor long, cls long, first long, words binary"


def _surroundings(batches):
    """Words around each marked anchor."""
    schema = pa.schema([("anchor", pa.int64()), ("cls", pa.int64()), ("first", pa.int64()), ("words", pa.binary())])

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    for batch in batches:
        out = [[], [], [], []]
        for data, c, marks in zip(column_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            s, e, h = words_of(data)
            if class_of(h) != c or not marks:
                continue
            g, at = anchors_of(h)
            words = joined_words(data, s, e)
            lo, hi = anchor_runs(g, at)
            ours = np.isin(at[lo], np.array(marks))
            for a, b in zip(lo[ours].tolist(), hi[ours].tolist()):
                out[0].append(int(g[at[a]].astype(np.int64)))
                out[1].append(c)
                out[2].append(a)
                out[3].append(b" ".join(words[a:b + WINDOW - 1]))
                if len(out[0]) >= 8192:
                    yield rows(out)
                    out = [[], [], [], []]
        yield rows(out)


# --- windows of hot anchors ----------------------------------------------------

BLOCKS = "bucket long, hashes binary, rows binary, places binary"
ONCE = "owner long, rows binary, places binary"
_PACKED = pa.schema([("bucket", pa.int64()), ("hashes", pa.binary()), ("rows", pa.binary()), ("places", pa.binary())])
# Surroundings whose once-only windows are looked up together.
OWNED_BITS = 9
# Window hashes of one bucket, about.
BUCKET_WINDOWS = 1 << 20


def _windows_of(words: list):
    """(window hashes, row, place in its row) of surroundings."""
    h = [runs(words_of(np.frombuffer(w, np.uint8))[2], WINDOW) for w in words]
    size = [len(x) for x in h]
    none = np.empty(0, np.int64)
    return (np.concatenate(h) if h else np.empty(0, np.uint64), np.repeat(np.arange(len(h)), size),
            np.concatenate([np.arange(n) for n in size]) if h else none)


def _grouped(keys: np.ndarray, columns: list):
    """Yields (key, its part of each column) of columns by key."""
    order = np.argsort(keys, kind="stable")
    keys, columns = keys[order], [c[order] for c in columns]
    ends = np.flatnonzero(np.diff(keys, append=keys[-1:] - 1)) + 1 if len(keys) else []
    lo = 0
    for hi in ends:
        yield int(keys[lo]), [c[lo:hi] for c in columns]
        lo = hi


def _window_blocks(buckets: int):
    """Per batch and bucket the distinct window hashes; a row of -1 where one recurs in the batch."""
    def run(batches):
        for batch in batches:
            rid = batch.column(0).to_numpy()
            h, row, place = _windows_of(batch.column(1).to_pylist())
            u, at, count = np.unique(h, return_index=True, return_counts=True)
            rows, places = np.where(count > 1, -1, rid[row[at]]), place[at]
            out = [(b, *(c.tobytes() for c in cols)) for b, cols in _grouped((u % np.uint64(buckets)).astype(np.int64), [u, rows, places])]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 4, _PACKED)], schema=_PACKED)

    return run


def _once(batches):
    """Streams blocks sorted by bucket; the windows that occur once in all, by owner."""
    schema = pa.schema([("owner", pa.int64()), ("rows", pa.binary()), ("places", pa.binary())])

    def single(parts):
        h, rows, places = (np.concatenate([np.frombuffer(p[i], t) for p in parts]) for i, t in enumerate((np.uint64, np.int64, np.int64)))
        _, at, count = np.unique(h, return_index=True, return_counts=True)
        at = at[(count == 1) & (rows[at] >= 0)]
        out = [(o, *(c.tobytes() for c in cols)) for o, cols in _grouped(rows[at] >> OWNED_BITS, [rows[at], places[at]])]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 3, schema)], schema=schema)

    key, parts = None, []
    for batch in batches:
        for b, *part in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if b != key and parts:
                yield single(parts)
                parts = []
            key = b
            parts.append(part)
    if parts:
        yield single(parts)


def _recurring(surroundings: pa.Table, once: pa.Table) -> pa.Table:
    """Surroundings of one owner with the numbers of their windows that recur."""
    known = set()
    for rows, places in zip(once["rows"].to_pylist(), once["places"].to_pylist()):
        known.update(zip(np.frombuffer(rows, np.int64).tolist(), np.frombuffer(places, np.int64).tolist()))
    left = []
    for rid, words in zip(surroundings["rid"].to_pylist(), surroundings["words"].to_pylist()):
        left.append([i for i in range(words.count(b" ") + 2 - WINDOW) if (rid, i) not in known])
    out = surroundings.select(["anchor", "cls", "first"]).append_column("windows", pa.array(left, pa.list_(pa.int64())))
    out = out.append_column("words", surroundings["words"])
    return out.filter(pa.array([bool(x) for x in left], pa.bool_()))


def confirm_hot(hot_rows: DataFrame) -> DataFrame:
    """(anchor, cls, first, windows, words) of surroundings with recurring windows."""
    n = hot_rows.count()
    buckets = max(16, n * SPREAD // BUCKET_WINDOWS)
    blocks = hot_rows.select("rid", "words").mapInArrow(_window_blocks(buckets), BLOCKS)
    once = blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_once, ONCE)
    owner = F.shiftright("rid", OWNED_BITS)
    return (hot_rows.withColumn("owner", owner).groupBy("owner").cogroup(once.groupBy("owner"))
            .applyInArrow(_recurring, "anchor long, cls long, first long, windows array<long>, words binary"))


def locate(pieces: list, confirmed: list) -> tuple:
    """(pieces, first words, numbers of words) where recurring passages occur.

    Occurrences that overlap in a piece are reported as one run of words.

    ``pieces`` are word sequences joined by one space.  ``confirmed`` holds,
    per piece, the numbers of its recurring windows, or None where the pieces
    themselves decide by counting.
    """
    # One buffer: a piece is "\n w1 w2 ... wn "; one byte is one character.
    text = b"".join(b"\n " + p + b" " for p in pieces)
    start, end, h = words_of(np.frombuffer(text, np.uint8))
    sizes = np.array([p.count(b" ") + 1 for p in pieces])
    first = np.concatenate([[0], np.cumsum(sizes)])
    all_windows = runs(h, WINDOW)
    owner = np.repeat(np.arange(len(pieces)), sizes)[:len(all_windows)]
    inside = np.arange(len(all_windows)) + WINDOW <= first[owner + 1]
    _, back, count = np.unique(all_windows[inside], return_inverse=True, return_counts=True)
    again = np.zeros(len(all_windows), bool)
    again[inside] = count[back] > 1
    for p, known in enumerate(confirmed):
        if known is not None:
            again[first[p]:first[p + 1] - WINDOW + 1] = False
            again[first[p] + np.array(known, np.int64)] = True
    # Maximal runs of recurring windows in a piece are the passages.
    edge = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]]).astype(np.int8)))
    automaton, flat, shape = ahocorasick.Automaton(), text.decode("latin-1"), []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        # Neighbouring pieces never share a passage.  Long passages are compiled in
        # parts, so that periodic ones of many lengths have few patterns.
        while a < b:
            stop = min(b, int(first[owner[a] + 1]) - WINDOW + 1, a + SPREAD)
            passage = flat[start[a] - 1:end[stop + WINDOW - 2] + 1]
            if passage not in automaton:
                automaton.add_word(passage, len(shape))
                shape.append((len(passage), stop - a + WINDOW - 1))
            a = stop
    none = np.empty(0, np.int64)
    if not shape:
        return none, none, none
    automaton.make_automaton()
    # Periodic texts match in very many ways: one number per match, no list.
    kinds = len(shape)
    found = np.fromiter((at * kinds + k for at, k in automaton.iter(flat)), np.int64)
    shape = np.array(shape, np.int64)[found % kinds]
    word = np.searchsorted(start, found // kinds - shape[:, 0] + 2)
    cover = np.zeros(first[-1] + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + shape[:, 1], -1)
    covered = np.cumsum(cover)[:-1] > 0
    opens = covered & ~np.concatenate([[False], covered[:-1]])
    opens[first[:-1]] |= covered[first[:-1]]
    closes = covered & ~np.concatenate([covered[1:], [False]])
    closes[first[1:] - 1] |= covered[first[1:] - 1]
    lo, hi = np.flatnonzero(opens), np.flatnonzero(closes)
    piece = np.searchsorted(first, lo, side="right") - 1
    return piece, lo - first[piece], hi - lo + 1


def _shards(batches):
    """Streams surroundings sorted by shard key; occurrences as word spans."""
    schema = pa.schema([("cls", pa.int64()), ("first", pa.int64()), ("words", pa.int64())])

    def spans(rows):
        piece, first, words = locate([r[4] for r in rows], [r[3] for r in rows])
        cls, at = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (cls[piece], at[piece] + first, words)], schema=schema)

    rows, key = [], None
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(5)]
        for r in zip(*cols):
            # A group of unconfirmed surroundings stays together; confirmed ones need not.
            if len(rows) >= SHARD and (r[0] != key or r[3] is not None):
                yield spans(rows)
                rows = []
            key = r[0]
            rows.append(r)
    if rows:
        yield spans(rows)


def _strip(keep_text: bool):
    """Removes a document's spans; counts, digests and (optionally) keeps the rest."""
    schema = pa.schema([("cls", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for data, c, spans in zip(column_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                s, e, h = words_of(data)
                if class_of(h) != c:
                    continue
                gone = np.zeros(len(h) + 1, np.int64)
                np.add.at(gone, [x["first"] for x in spans], 1)
                np.add.at(gone, [x["first"] + x["words"] for x in spans], -1)
                keep = np.cumsum(gone)[:-1] == 0
                words = joined_words(data, s[keep], e[keep])
                out[0].append(c)
                out[1].append(int(len(h) - keep.sum()))
                out[2].append(_digest(words))
                out[3].append(b" ".join(words).decode("utf-8", "replace") if keep_text else None)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False,
                   hot: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    With ``keep_text`` also kept_text, for documents that lost some but not
    all of their words (null: nothing was removed, or everything).
    """
    hot = HOT if hot is None else hot
    # A row is found again by its id and a hash of its text: null and repeated ids
    # alone would pair every such row with every class.
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    scan = materialize(src.mapInArrow(_scan, SCAN), "anchors")
    rows = scan.select("doc_id", "n_words", "cls", "sha256")
    classes = scan.groupBy("cls").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "doc_id")).alias("first_row"))

    # Anchors that start at two places (class, word) or more, counted map-side first.
    places = (scan.select("cls", F.explode(F.arrays_zip("anchors", "places")).alias("x"))
              .select("cls", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place")))
    at = F.struct("cls", "place")
    again = materialize(places.groupBy("anchor").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n"))
                        .filter("lo != hi").select("anchor", "n"), "recurring")
    marked = attach_groups(places, again, "anchor", "n", how="inner")
    marks = marked.groupBy("cls").agg(F.collect_set(F.struct("place", (F.col("n") > hot).alias("hot"))).alias("marks"))
    asked = marks.join(classes, "cls").select("cls", F.col("first_row.key").alias("key"), F.col("first_row.doc_id").alias("first_id"),
                                              "marks", "copies")
    texts = materialize(src.join(asked, (src["key"] == asked["key"]) & src["doc_id"].eqNullSafe(asked["first_id"]))
                        .select("text", "cls", "marks", "copies"), "affected")

    def around(is_hot):
        own = F.transform(F.filter("marks", lambda m: m["hot"] if is_hot else ~m["hot"]), lambda m: m["place"])
        return texts.select("text", "cls", own.alias("own")).filter(F.size("own") > 0).mapInArrow(_surroundings, SURROUNDINGS)

    hot_rows = materialize(around(True).withColumn("rid", F.monotonically_increasing_id()), "hot")
    hot_rows = confirm_hot(hot_rows).withColumn("salt", F.pmod(F.xxhash64("cls", "first"), F.lit(SALTS)))
    none = F.lit(None).cast("array<long>")
    cold = around(False).select("anchor", "cls", "first", none.alias("windows"), "words", F.lit(0).cast("long").alias("salt"))
    shards = (cold.unionByName(hot_rows)
              .repartition("anchor", "salt").sortWithinPartitions("anchor"))
    found = shards.drop("salt").mapInArrow(_shards, "cls long, first long, words long")

    spans = found.groupBy("cls").agg(F.collect_list(F.struct("first", "words")).alias("spans"))
    cut = (texts.filter("copies = 1").select("text", "cls").join(spans, "cls").select("text", "cls", "spans")
           .mapInArrow(_strip(keep_text), "cls long, n_removed long, kept_sha256 string, kept_text string"))
    verdict = (classes.join(cut, "cls", "left")
               .filter("copies > 1 OR n_removed IS NOT NULL")
               .select("cls", "copies", "n_removed", "kept_sha256", "kept_text"))
    verdict = materialize(verdict, "verdict")  # read twice below
    out = attach_groups(rows, verdict, "cls", "copies")
    every = (F.coalesce("copies", F.lit(1)) > 1) & (F.col("n_words") >= WINDOW)
    cols = ["doc_id", "n_words",
            F.when(every, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(every, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256")]
    return out.select(*cols, *(["kept_text"] if keep_text else []))
