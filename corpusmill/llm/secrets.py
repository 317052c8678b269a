"""Secret scan with corpus-wide ownership frequency (native).

One scan finds candidate spans: the three base kinds (assign, access, hex)
and further shapes (JSON web tokens, vendor-prefixed keys, private-key
headers, URL credentials, long mixed-case opaque strings).  Each candidate's
value is hashed; the hashes are aggregated by distinct repositories and
owners over the whole corpus.  A value that many owners or many repositories hold
is a widely copied example; one of a single owner, in few repositories, is live-looking.  Base spans always
stay; a span of a further shape is added only if its value is owner-specific
and it overlaps no base span.

Defined results: a null text has no spans; null owners or repositories count
as one owner or repository named ''; repeated rows each get their own result
row and count once towards distinct owners; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import apart, attach_groups, match_spans, materialize

# The base patterns, in the order of the kinds.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
# Maximal runs, so asking for the least length in the pattern finds the same
# spans as filtering afterwards (not so for ASSIGN, whose short matches count).
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")
MIN_ASSIGN = 12

# Further candidate shapes: kind -> pattern.
EXTRA = {
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+",
    "vendor": r"(?:gh[pousr]_|sk_live_|glpat-|xox[abprs]-)[A-Za-z0-9_-]{16,}",
    "pem": r"-----BEGIN (?:[A-Z]++ )*?PRIVATE KEY-----",
    "url": r"://[^\x20/:@\x09-\x0D]++:[^\x20/@\x09-\x0D]{6,}+@",
    "opaque": r"[A-Za-z0-9+/_-]{32,}={0,2}",
}
KIND_ORDER = {k: i for i, k in enumerate((*BASE_KINDS, *EXTRA))}


def _tagged(kind: str, spans: Column, value=lambda m: m) -> Column:
    """Spans as structs that sort by start, then kind."""
    return F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.lit(KIND_ORDER[kind]).alias("k"), x["e"].alias("e"),
        F.lit(kind).alias("kind"), F.sha2(value(x["m"]), 256).alias("h")))


def _base(text: str) -> Column:
    assign = F.filter(match_spans(text, ASSIGN),
                      lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= MIN_ASSIGN)
    return F.array_sort(F.concat(
        _tagged("assign", assign, lambda m: F.regexp_extract(m, ASSIGN, 2)),
        _tagged("access", match_spans(text, ACCESS)),
        _tagged("hex", match_spans(text, HEX))))


def _extra(text: str) -> Column:
    parts = []
    for kind, pattern in EXTRA.items():
        spans = match_spans(text, pattern)
        if kind == "opaque":
            spans = F.filter(spans, lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[a-z]") & x["m"].rlike("[A-Z]"))
        parts.append(_tagged(kind, spans))
    return F.array_sort(F.concat(*parts))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_cols: tuple = ("source", "lang"), live_owners: int = 1, copied_owners: int = 3,
                 live_repos: int = 2, copied_repos: int = 4) -> DataFrame:
    """One row per input row: doc_id, base spans, added spans, n_live, n_copied, owners, repos.

    ``base`` and ``added`` are arrays of (start, kind order, end, kind, value
    hash).  A value is live-looking with at most ``live_owners`` owners and at
    most ``live_repos`` repositories, copied with ``copied_owners`` owners or
    ``copied_repos`` repositories.  ``owners`` and ``repos`` are the largest numbers of
    either that a value of the row has.
    """
    src = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols]).alias("repo"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = materialize(src.select("rid", "doc_id", "owner", "repo", _base("text").alias("base"), _extra("text").alias("extra")), "secrets")
    kind = rows.schema["extra"].dataType.elementType.simpleString()
    rows = rows.withColumn("free", apart(F.col("extra"), F.col("base"), kind))

    found = (rows.filter((F.size("base") > 0) | (F.size("free") > 0))
             .select("rid", "owner", "repo", F.explode(F.concat("base", "free")).alias("c"))
             .select("rid", "owner", "repo", F.col("c.h").alias("h"), F.col("c").alias("span")))
    per_repo = found.groupBy("h", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repo.groupBy("h", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_repos"))
    freq = per_owner.groupBy("h").agg(F.sum("n").alias("n"), F.sum("n_repos").alias("repos"),
                                      F.count(F.lit(1)).alias("owners"))
    judged = attach_groups(found, freq, "h", "n")
    live = (F.col("owners") <= live_owners) & (F.col("repos") <= live_repos)
    copied = (F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos)
    per_row = judged.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.when(live & (F.col("span.k") >= len(BASE_KINDS)), F.col("span")))).alias("added"),
        F.count(F.when(live, 1)).alias("n_live"),
        F.count(F.when(copied, 1)).alias("n_copied"), F.max("owners").alias("owners"), F.max("repos").alias("repos"))
    empty = F.filter("base", lambda x: F.lit(False))
    return rows.join(per_row, "rid", "left").select(
        "doc_id", "base", F.coalesce("added", empty).alias("added"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
        F.coalesce("owners", F.lit(0)).cast("long").alias("owners"), F.coalesce("repos", F.lit(0)).cast("long").alias("repos"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"),
                                                                 x["e"].cast("string"))), ",")


def digest_columns(found: DataFrame) -> DataFrame:
    def n_of(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(n_of, BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("base", "added"))).alias("spans"), "n_live", "n_copied", "owners", "repos")
