"""Merkle manifest against plain Python; odd fan-outs and awkward rows."""

import hashlib
import zlib
from string import ascii_lowercase, ascii_uppercase

from corpusmill.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g long, tree string, own int"


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(r):
    return _h("".join(map(_enc, r)))


def _levels(hashes, fan):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + fan])) for i in range(0, len(out[-1]), fan)])
    return out


def _sides(levels, i, fan):
    for level in levels[:-1]:
        a = i // fan * fan
        run = level[a:a + fan]
        yield "".join(run[:i - a]), "".join(run[i - a + 1:])
        i //= fan


def _brute(rows, fan=8):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees.append((own, _levels([_leaf(r) for r in own], fan)))
    top = _levels([t[-1][0] for _, t in trees], fan)
    out = []
    for g, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            path = [*_sides(levels, i, fan), *_sides(top, g, fan)]
            leaf = cur = _leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                cur = _leaf((*r[:4], r[4].translate(str.maketrans(ascii_uppercase, ascii_lowercase))))
            for a, b in path:
                cur = _h(a + cur + b)
            root = top[-1][0]
            out.append((r[0], leaf, levels[-1][0], root, _h("".join(a + b for a, b in path)), cur, cur == root))
    return sorted(out, key=str)


def _run(spark, rows, fan=8):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in M.manifest(df, fan).collect()), key=str)


ROWS = ([(i, f"s{i % 4}", "en", i, f"Text {i} É ABC") for i in range(75)]
        + [(1000 + i, None, "de", None, None if i % 2 else "") for i in range(9)]
        + [(i, "s", None, 3, "No language HERE") for i in range(3)]
        + [(5, "s", "zz", 1, "Lone Leaf"), (7, "s", "", 0, "X" * 50000), (8, "s", "", 0, "Y")]
        + [(None, "s", "en", 1, "no id A"), (None, "s", "en", 1, "no id B"), (3, "s3", "en", 3, "Other Text")]
        + [(4, "s0", "en", 4, "Text 4 É ABC")] * 3)


def test_matches_brute_force(spark):
    got = _run(spark, ROWS)
    assert got == _brute(ROWS)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_binary_and_ternary_trees(spark):
    for fan in (2, 3):
        assert _run(spark, ROWS[:40], fan) == _brute(ROWS[:40], fan)


def test_one_row_and_many_languages(spark):
    for rows in ([(5, "s", "en", 1, "A")], [(i, "s", f"l{i:02}", 1, "A") for i in range(70)]):
        assert _run(spark, rows) == _brute(rows)


def test_empty(spark):
    assert _run(spark, []) == []
