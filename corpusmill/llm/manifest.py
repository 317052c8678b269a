"""Merkle manifest of a dataset by sibling-shift self-joins.

Each row is a leaf; leaves of a language form a tree, the subroots of all
languages form the top tree.  Nodes are rows (g, i, n, h): tree, index in its
level, nodes in that level of the tree, hash.

* Leaves are numbered by range partitions of (language, id), so that a language
  with most of the rows is spread like others.  ``g`` is the number of its first leaf.
* At each level every node asks for the indices of its run (slot offsets, or
  XOR where the fan-out is two) and an equijoin on (g, index) answers.  A node thus
  knows what stands left and right of it in its run; the rows in slot zero emit
  the parents, an eighth of the rows.
* Back down, a node's path is its own siblings and its parent's path: another equijoin
  on (g, index of the parent).  Proof and folded root are one fold over the path
  of a leaf.  Paths travel with parents, so a leaf adds 56 bytes a level.

The driver learns the largest number of leaves of a tree, which gives the
number of levels, and the root.

Defined results: a null field is ``-`` in its leaf, empty text is ``0:``.  Null languages and null ids come first; leaves
of one language and id are in order of their hashes; repeated rows have equal leaves
in neighbouring places.  Null ids are never tampered with.  A lone leaf is its
own subroot, a lone subroot the root; a proof without siblings is the hash of
nothing.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import attach_groups, materialize
from corpusmill.operators.positions import range_positions

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(columns: list) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns]), 256))


def _hex(h) -> Column:
    return F.lower(F.hex(h))


def leaves_of(docs: DataFrame) -> DataFrame:
    """doc_id, tree (a key of the language), h, t: the leaf hash, and that of the tampered row."""
    cols = [F.col(c) for c in FIELDS]
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf_hash(cols).alias("h"),
        F.when(chosen, leaf_hash([*cols[:-1], lowered])).alias("t"))


def families(nodes: DataFrame, fan: int) -> DataFrame:
    """Each node of a level with what stands left and right of it in its run.

    ``nodes`` are (g, i, n, h, own) of trees with several nodes in this level; ``own``
    is carried along.  Gives (g, i, n, h, own, l, r).
    """
    slot = F.pmod("i", F.lit(fan))
    run = F.least(F.lit(fan), F.col("n") - F.col("i") + slot)
    ask = nodes.select("g", "i", "n", "own", slot.alias("slot"), run.alias("run"),
                       F.explode(F.sequence(F.lit(0), run.cast("int") - 1)).alias("d"))
    sibling = (F.col("i").bitwiseXOR(F.col("d").cast("bigint")) if fan == 2
               else F.col("i") - F.col("slot") + F.pmod(F.col("slot") + F.col("d"), F.col("run")))
    ask = ask.select("g", "i", "n", F.when(F.col("d") == 0, F.col("own")).alias("own"), sibling.alias("at"))
    met = ask.join(nodes.select("g", F.col("i").alias("at"), "h"), ["g", "at"])
    fam = met.groupBy("g", "i", "n").agg(
        F.any_value("own", F.lit(True)).alias("own"),
        F.array_sort(F.collect_list(F.struct("at", "h"))).alias("fam"))

    def side(keep):
        return F.aggregate(F.filter("fam", keep), F.lit(b""), lambda a, x: F.concat(a, x["h"]))

    i = F.col("i")
    return fam.select("g", "i", "n", F.filter("fam", lambda x: x["at"] == i)[0]["h"].alias("h"), "own",
                      side(lambda x: x["at"] < i).alias("l"), side(lambda x: x["at"] > i).alias("r"))


def climb(nodes: DataFrame, widest: int, fan: int) -> tuple:
    """(families of each level, tops): tops are (g, h, own, level) of trees that are down to one node."""
    levels, tops = [], [nodes.filter("n = 1").select("g", "i", "h", "own", F.lit(0).alias("level"))]
    while widest > 1:
        fam = materialize(families(nodes.filter("n > 1"), fan), "families")
        levels.append(fam)
        nodes = fam.filter(F.pmod("i", F.lit(fan)) == 0).select(
            "g", F.expr(f"i div {fan}").alias("i"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
            F.unhex(F.sha2(F.concat(_hex("h"), _hex("r")), 256)).alias("h"), F.lit(None).cast(nodes.schema["own"].dataType).alias("own"))
        widest = -(-widest // fan)
        tops.append(nodes.filter("n = 1").select("g", "i", "h", "own", F.lit(len(levels)).alias("level")))
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return levels, materialize(out, "tops")


def descend(levels: list, tops: DataFrame, above: DataFrame, fan: int) -> DataFrame:
    """(g, i, h, own, top, path) of every node of the lowest level.

    ``above`` has (g, path) of each tree's top; ``path`` is array<struct<l, r>>, lowest level first.
    """
    crowned = tops.join(above, "g").select("g", "i", "h", "own", F.col("h").alias("top"), "path", "level")

    def of(level):
        return crowned.filter(F.col("level") == level).drop("level")

    known = of(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        parents = (known if k == len(levels) - 1 else materialize(known, "paths")).select(
            "g", F.col("i").alias("up"), "top", F.col("path").alias("rest"))
        nodes = levels[k].withColumn("up", F.expr(f"i div {fan}")).join(parents, ["g", "up"])
        known = nodes.select("g", "i", "h", "own", "top", F.concat(
            F.array(F.struct("l", "r")), "rest").alias("path")).unionByName(of(k))
    return known


def manifest(docs: DataFrame, fan: int = FAN_OUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    no_path = F.array().cast("array<struct<l:binary,r:binary>>")
    # The row number breaks ties, so that a hot id can be split over partitions.
    leaves = materialize(leaves_of(docs).withColumn("tie", F.monotonically_increasing_id()), "leaves")
    placed = range_positions(leaves, [F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), "h", "tie"])
    key = F.coalesce(F.sha2("lang", 256), F.lit("null"))
    placed = placed.select(key.alias("tree"), "seq", "h", F.struct("doc_id", "t").alias("own"))
    trees = materialize(placed.groupBy("tree").agg(F.min("seq").alias("g"), F.count(F.lit(1)).alias("n")), "trees")
    widest, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    nodes = attach_groups(placed, trees, "tree", "n").select(
        "g", (F.col("seq") - F.col("g")).alias("i"), "n", "h", "own")
    levels, tops = climb(materialize(nodes, "nodes"), widest or 0, fan)

    subroots = range_positions(tops.select("g", "h"), ["g"]).select(
        F.lit(0).cast("long").alias("g"), F.col("seq").alias("i"), F.lit(n_trees).cast("long").alias("n"), "h", F.struct("g").alias("own"))
    high, root = climb(subroots, n_trees, fan)
    # An empty table has no root, and nothing to join it with.
    root = [bytes(r.h).hex() for r in root.select("h").collect()], root
    above = descend(high, root[1], docs.sparkSession.range(1).select(F.col("id").alias("g"), no_path.alias("path")), fan)
    above = materialize(above.select(F.col("own.g").alias("g"), "path"), "subroots")

    out = descend(levels, tops, above, fan)
    folded = F.aggregate("path", _hex(F.coalesce("own.t", "h")), lambda acc, x: F.sha2(
        F.concat(_hex(x["l"]), acc, _hex(x["r"])), 256))
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(_hex(x["l"]), _hex(x["r"]))), ""), 256)
    top = F.lit(root[0][0] if root[0] else None).cast("string")
    return out.select(F.col("own.doc_id").alias("doc_id"), _hex("h").alias("leaf"), _hex("top").alias("subroot"),
                      top.alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
