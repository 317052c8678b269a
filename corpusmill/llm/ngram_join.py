"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link when the Jaccard similarity of their sets of distinct
5-word shingles is 0.75 or more.  ``component_id`` is the smallest doc_id
reachable by links.

1. One scan hashes each document's shingles.  Documents with equal sets form a
   class (64-bit hash of the sorted set, with its size); copies go no further.
   The scan also reports shingles that several documents of a window of the
   scan share; the ``COMMON`` most frequent are broadcast (a fixed bound).
2. A second scan posts, per class, the shingles that a partner must meet.  Of n
   shingles these are the first n - ceil(0.75 n) + c in a global order, rare
   before common, with c = 0.15 n: two linked classes share at least the
   smaller c of their posted shingles.  Any order and c are exact; these keep
   the lists short and their number telling.
3. A class with fewer shared lists than the least c of any partner has no link
   and leaves.  In each remaining list, classes in order of size form chains
   in which sizes stay within the ratio 0.75 of the next; every chain of two
   or more names its smallest class as its centre.  A block is a centre with all classes of its
   chains, so every pair that may link meets in a block.  Blocks above
   ``BLOCK_SHINGLES`` are cut into parts, and pairs of parts become blocks.
4. In a block each class is first compared with its neighbours in its shortest
   lists, which joins groups of near copies in linear time; a query then steps over the
   members of its own component in each list.  What remains is a
   T-occurrence query (DivideSkip) against an inverted index of the block: with T = ceil(0.75 n), the lists of its
   shingles are sorted by length, all but the L longest are merged with a heap, candidates
   with T - L occurrences or more are looked up in the long lists by binary search, and
   those that reach the required overlap link.  A candidate already connected
   to the query is skipped, so a block reports a spanning forest, not all pairs.
5. Components of the links (star contraction) give each class its root.

Only the texts of classes in blocks are read a third time.

Defined results: null and blank texts have an empty set, link with nothing and
keep their own id; texts below five words have one shingle, their whole
sequence; repeated rows belong to one class; a null doc_id is never a
component's smallest unless all are null; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import attach_groups, materialize
from corpusmill.llm.components import components
from corpusmill.llm.words import column_bytes, runs, words_of

SHINGLE = 5
PERCENT = 75
EXTRA = 15
COMMON = 1 << 18
WINDOW_SHINGLES = 4_000_000
BLOCK_SHINGLES = 2_000_000
MU = 1.0
# Shortest lists of a set in which it is compared with its neighbour at once.
PROBES = 3
TURNS = 8
HEAP_ENTRIES = 4096


def shingle_set(data: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's bytes."""
    h = words_of(data, fold=True)[2]
    return np.unique(runs(h, min(n, len(h)))) if len(h) else h


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), len(shingles)) - (1 << 63)


def required(n) -> int:
    """Least overlap with any partner of a set of n: ceil(0.75 n)."""
    return (PERCENT * n + 99) // 100


def surplus(n):
    """c: how many posted shingles two linked classes must share."""
    return max(1, EXTRA * n // 100)


def linked(overlap, a, b):
    return 100 * overlap >= PERCENT * (a + b - overlap)


# --- scans -----------------------------------------------------------------

FEATURES = "doc_id long, key long, n_shingles long, cls long, hash long, times long"


def _features(batches):
    """Per document its class; per window of the scan its repeated shingles."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()),
                        ("hash", pa.int64()), ("times", pa.int64())])
    pool, size, classes = [], 0, set()

    def repeated():
        if not pool:
            return
        h, n = np.unique(np.concatenate(pool), return_counts=True)
        h, n = h[n > 1].view(np.int64), n[n > 1]
        for lo in range(0, len(h), 65536):
            k = len(h[lo:lo + 65536])
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64())] * 4 + [pa.array(h[lo:lo + 65536]), pa.array(n[lo:lo + 65536])], schema=schema)

    for batch in batches:
        n, cls = [], []
        for data in column_bytes(batch.column(2)):
            s = shingle_set(data)
            c = class_of(s)
            n.append(len(s))
            cls.append(c)
            if len(s) and c not in classes:
                classes.add(c)
                pool.append(s)
                size += len(s)
        k = len(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                                          pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=schema)
        if size > WINDOW_SHINGLES:
            yield from repeated()
            pool, size, classes = [], 0, set()
    yield from repeated()


def prefix(s: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The posted shingles of a set: rare ones by hash, then common by rank."""
    p = len(s) - required(len(s)) + surplus(len(s))
    if len(common):
        at = np.minimum(np.searchsorted(common, s), len(common) - 1)
        s = s[np.argsort(np.where(common[at] == s, rank[at], 0), kind="stable")]
    return s[:p]


def _postings(shared):
    schema = pa.schema([("hash", pa.int64()), ("cls", pa.int64()), ("n", pa.int32())])

    def run(batches):
        common, rank = (np.frombuffer(x, t) for x, t in zip(shared.value, (np.uint64, np.int32)))
        done = set()
        for batch in batches:
            hashes, cls, sizes = [], [], []
            for data in column_bytes(batch.column(0)):
                s = shingle_set(data)
                c = class_of(s)
                if len(s) and c not in done:
                    done.add(c)
                    hashes.append(prefix(s, common, rank))
                    cls.append(c)
                    sizes.append(len(s))
            if len(done) > 1_000_000:
                done.clear()
            if not hashes:
                continue
            k = [len(h) for h in hashes]
            h, c, n = np.concatenate(hashes).view(np.int64), np.repeat(np.array(cls, np.int64), k), np.repeat(np.array(sizes, np.int32), k)
            for lo in range(0, len(h), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo:lo + 65536]) for x in (h, c, n)], schema=schema)

    return run


def _members(batches):
    """Shingle sets of the classes that blocks ask for, one row per block."""
    schema = pa.schema([("centre", pa.int64()), ("part", pa.int64()), ("cls", pa.int64()), ("shingles", pa.binary())])
    for batch in batches:
        wanted, blocks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for data, c, own in zip(column_bytes(batch.column(0)), wanted, blocks):
            s = shingle_set(data)
            if class_of(s) == c:
                raw = s.tobytes()
                for lo in range(0, len(own), 64):
                    some = own[lo:lo + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b["centre"] for b in some], pa.int64()), pa.array([b["part"] for b in some], pa.int64()),
                         pa.array([c] * len(some), pa.int64()), pa.array([raw] * len(some), pa.binary())], schema=schema)


# --- T-occurrence search -----------------------------------------------------

class Forest:
    """Union-find with path halving; the root of a component is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        up = np.array(self.up)
        while (up[up] != up).any():
            up = up[up]
        return up


def heap_merge(lists: list, least: int) -> list:
    """(member, occurrences) of members in ``least`` or more of the sorted lists.

    Beyond ``HEAP_ENTRIES`` the same merge is one vectorised sort: a heap steps through Python
    for each entry.
    """
    if sum(map(len, lists)) > HEAP_ENTRIES:
        member, times = np.unique(np.concatenate(lists), return_counts=True)
        enough = times >= least
        return list(zip(member[enough].tolist(), times[enough].tolist()))
    out, last, times = [], -1, 0
    for member in heapq.merge(*[x.tolist() for x in lists]):
        if member != last:
            if times >= least:
                out.append((last, times))
            last, times = member, 0
        times += 1
    if times >= least:
        out.append((last, times))
    return out


class Block:
    """Inverted index of a block's sets, and the links found in it so far."""

    def __init__(self, sets: list):
        self.sets, self.sizes = sets, [len(s) for s in sets]
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        new = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(flat)))
        number = np.empty(len(flat), np.int64)
        number[order] = np.cumsum(new) - 1
        # Only lists of two members or more; ascending in each.
        keep = length > 1
        self.first, self.length = first[keep], length[keep]
        renamed = np.where(keep, np.cumsum(keep) - 1, -1)[number]
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.list_at = renamed  # list of each place of the sets, -1 for none
        self.owner, self.kept = owner, np.repeat(keep, length)
        self.forest, self.links = Forest(len(sets)), []

    def lists_of(self, q: int) -> np.ndarray:
        x = self.list_at[self.ends[q]:self.ends[q + 1]]
        return x[x >= 0]

    def members(self, k: int) -> np.ndarray:
        return self.owner[self.first[k]:self.first[k] + self.length[k]]

    def try_pair(self, a: int, b: int) -> None:
        """Compares two whole sets; links them where they reach the threshold."""
        if self.forest.find(a) == self.forest.find(b):
            return
        small, large = sorted((self.sizes[a], self.sizes[b]))
        if 100 * small < PERCENT * large:
            return
        x, y = self.sets[a], self.sets[b]
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        if linked(int((y[at] == x).sum()), self.sizes[a], self.sizes[b]) and self.forest.join(a, b):
            self.links.append((min(a, b), max(a, b)))

    def link_neighbours(self) -> None:
        """Compares each set with the one before it in its shortest lists, and
        with the first member of that one's component.  Groups of near copies
        become one component here, in time linear in their size."""
        for q in range(len(self.sets)):
            lists = self.lists_of(q)
            if len(lists) < required(self.sizes[q]):
                continue
            for k in lists[np.argsort(self.length[lists], kind="stable")[:PROBES]].tolist():
                own = self.members(k)
                at = int(np.searchsorted(own, q))
                if at:
                    before = int(own[at - 1])
                    self.try_pair(before, q)
                    self.try_pair(self.forest.find(before), q)

    def link_stragglers(self) -> None:
        """Sets outside the largest component try others of their shortest lists, so
        that a group of near copies does not stay in pieces."""
        for turn in range(TURNS):
            root = self.forest.roots()
            kinds, size = np.unique(root, return_counts=True)
            known = len(self.links)
            for q in np.flatnonzero(root != kinds[size.argmax()]).tolist():
                lists = self.lists_of(q)
                if len(lists) < required(self.sizes[q]):
                    continue
                for k in lists[np.argsort(self.length[lists], kind="stable")[:PROBES]].tolist():
                    own = self.members(k)
                    self.try_pair(int(own[(q * 2654435761 + turn * 40503) % len(own)]), q)
            if len(self.links) == known:
                break

    def group_lists(self) -> None:
        """Orders each list by component, so that a query steps over its own component.

        Components may have merged since; that only leaves more to look at.
        """
        root = self.forest.roots()
        owner = self.owner[self.kept]
        number = np.repeat(np.arange(len(self.first)), self.length)
        order = np.lexsort((owner, root[owner], number))
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.grouped, number = owner[order], number[order]
        new = np.concatenate([[True], (np.diff(number) != 0) | (np.diff(root[self.grouped]) != 0)])
        first = np.flatnonzero(new)
        part = np.cumsum(new) - 1
        # Of each member, by list number: where its own component starts and ends.
        mine = np.lexsort((number, self.grouped))
        self.at = np.searchsorted(self.grouped[mine], np.arange(len(self.sets) + 1))
        self.own_list, self.own_from = number[mine], first[part[mine]]
        self.own_to = np.append(first[1:], len(owner))[part[mine]]

    def search(self, q: int) -> None:
        """T-occurrence query of set ``q`` against earlier members of other components."""
        need, n = required(self.sizes[q]), self.sizes[q]
        mine = slice(self.at[q], self.at[q + 1])
        lists, lo, hi = self.own_list[mine], self.own_from[mine], self.own_to[mine]
        others = self.length[lists] - (hi - lo)
        if np.count_nonzero(others) < need:
            return
        order = np.argsort(others, kind="stable")
        order = order[others[order] > 0]
        skip = min(need - 1, int(need / (MU * math.log2(max(2, others[order[-1]])) + 1)))
        short, long = order[:len(order) - skip], order[len(order) - skip:]
        heads = []
        for i in short.tolist():
            k = lists[i]
            own = np.concatenate([self.grouped[self.start[k]:lo[i]], self.grouped[hi[i]:self.start[k + 1]]])
            heads.append(np.sort(own[own < q]))
        found = heap_merge([h for h in heads if len(h)], need - skip)
        found.sort(key=lambda x: -x[1])
        for c, times in found:
            if self.forest.find(c) == self.forest.find(q):
                continue  # a link settles all others of that component
            if 100 * min(self.sizes[c], n) < PERCENT * max(self.sizes[c], n):
                continue
            left = skip
            for i in long.tolist():
                if times + left < need:
                    break
                left -= 1
                own = self.members(lists[i])
                at = int(np.searchsorted(own, c))
                times += at < len(own) and int(own[at]) == c
            if times >= need and linked(times, self.sizes[c], n) and self.forest.join(c, q):
                self.links.append((c, q))


def spanning_links(sets: list) -> list:
    """Pairs of set numbers, the smaller first, that span the components of the block's links."""
    block = Block(sets)
    if len(block.first):
        block.link_neighbours()
        block.link_stragglers()
        block.group_lists()
        known = len(block.links)
        for q in range(1, len(sets)):
            block.search(q)
            if len(block.links) > 2 * known + 16:
                block.group_lists()
                known = len(block.links)
    return block.links


def _search(batches):
    """Streams rows sorted by block; the components of each block's links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    key, members = None, {}

    def links():
        ids = np.array(sorted(members), np.int64)
        forest = Forest(len(ids))
        for a, b in spanning_links([members[i] for i in ids.tolist()]):
            forest.join(a, b)
        # As stars around the smallest class, which settle fastest.
        root = forest.roots()
        linked_to = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[root[linked_to]]), pa.array(ids[linked_to])], schema=schema)

    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(3)]
        for i, k in enumerate(zip(cols[0].tolist(), cols[1].tolist())):
            if k != key:
                if len(members) > 1:
                    yield links()
                key, members = k, {}
            members[int(cols[2][i])] = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64).copy()
    if len(members) > 1:
        yield links()


# --- the join ----------------------------------------------------------------

def _blocks(postings: DataFrame) -> DataFrame:
    """(centre, part, cls): the blocks every class belongs to."""
    w = Window.partitionBy("hash")
    lists = postings.withColumn("low", F.min("cls").over(w)).withColumn("high", F.max("cls").over(w))
    lists = materialize(lists.filter("low != high").select("hash", "cls", "n").distinct(), "lists")
    # The least c of any partner: that of a partner of size ceil(0.75 n).
    smallest = F.floor((PERCENT * F.col("n") + 99) / 100)
    enough = (lists.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("shared"))
              .filter(F.col("shared") >= F.greatest(F.lit(1), F.floor(EXTRA * smallest / 100))))
    lists = lists.join(enough.select("cls"), "cls", "left_semi")
    by_size = w.orderBy("n", "cls")
    breaks = F.coalesce(PERCENT * F.col("n") > 100 * F.lag("n").over(by_size), F.lit(True)).cast("int")
    chain = Window.partitionBy("hash", "chain")
    lists = (lists.withColumn("breaks", breaks)
             .withColumn("chain", F.sum("breaks").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("centre", F.min("cls").over(chain)).withColumn("last", F.max("cls").over(chain)))
    pairs = lists.filter("centre != last").select("centre", "cls", "n").distinct()
    pairs = materialize(pairs, "blocks")
    parts = (pairs.groupBy("centre").agg(F.sum("n").alias("total"))
             .withColumn("parts", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")))
    split = attach_groups(pairs, parts, "centre", "total", how="inner")
    own = F.pmod(F.xxhash64("cls"), F.col("parts"))
    # Part i of k meets part j in block i * k + j, i <= j.
    meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1),
                        lambda j: F.least(own, j) * F.col("parts") + F.greatest(own, j))
    return split.select("centre", "cls", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long")))
                                                   .otherwise(meets)).alias("part"))


def _common(repeated: DataFrame):
    """At most ``COMMON`` most repeated shingles: sorted hashes, their ranks."""
    freq = materialize(repeated.groupBy("hash").agg(F.sum("times").alias("times")), "repeated")
    least, held = None, 0
    for r in sorted(freq.groupBy("times").agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        if held + r.n > COMMON:
            break
        least, held = r.times, held + r.n
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    top = freq.filter(F.col("times") >= least).toArrow()
    h, times = top["hash"].to_numpy().view(np.uint64), top["times"].to_numpy()
    order = np.argsort(h)
    h, times = h[order], times[order]
    rank = np.empty(len(h), np.int32)
    rank[np.lexsort((h, times))] = np.arange(1, len(h) + 1, dtype=np.int32)
    return h, rank


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, component_size."""
    spark = docs.sparkSession
    # A row is found again by its id and a hash of its text: null and repeated ids
    # alone would pair every such row with every class.
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    scan = materialize(src.mapInArrow(_features, FEATURES), "features")
    feats = scan.filter("cls IS NOT NULL").select("doc_id", "key", "n_shingles", "cls")

    common, rank = _common(scan.filter("cls IS NULL"))
    shared = spark.sparkContext.broadcast((common.tobytes(), rank.tobytes()))

    postings = src.select("text").mapInArrow(_postings(shared), "hash long, cls long, n int")
    blocks = materialize(_blocks(postings), "parts")
    classes = (feats.filter("n_shingles > 0").groupBy("cls", "n_shingles")
               .agg(F.min(F.struct("key", "doc_id")).alias("first"), F.count(F.lit(1)).alias("class_size")))
    asked = (blocks.groupBy("cls").agg(F.collect_list(F.struct("centre", "part")).alias("blocks"))
             .join(classes.select("cls", F.col("first.key").alias("key"), F.col("first.doc_id").alias("first_id")), "cls"))
    texts = (src.join(asked, (src["key"] == asked["key"]) & src["doc_id"].eqNullSafe(asked["first_id"]))
             .select("text", "cls", "blocks"))
    members = texts.mapInArrow(_members, "centre long, part long, cls long, shingles binary")
    links = (members.repartition("centre", "part").sortWithinPartitions("centre", "part")
             .mapInArrow(_search, "a long, b long"))
    roots = components(links, "a", "b")

    rooted = attach_groups(feats.drop("key"), classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                           .select("cls", "class_size", F.coalesce("root", "cls").alias("root")),
                           "cls", "class_size")
    rooted = materialize(rooted.withColumn("root", F.when(F.col("n_shingles") > 0, F.col("root"))), "rooted")
    ids = rooted.filter("root IS NOT NULL").groupBy("root").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("members"))
    out = attach_groups(rooted, ids, "root", "members")
    return out.select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
                      F.coalesce("members", F.lit(1)).cast("long").alias("component_size"))
