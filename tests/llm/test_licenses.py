"""License scans against plain Python: base places, rules, suppression."""

import re
from collections import Counter

from corpusmill.llm import licenses as L
from corpusmill.llm.license_rules import rules
from tests.llm.conftest import make_rows

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "Licensed under the Apache License, Version 2.0; see http://www.apache.org/licenses/LICENSE-2.0",
    "SPDX-License-Identifier: MIT", "the MIT License. mit-license MIT LICENSE", "CC BY-SA 4.0 and cc by", "cc\x00by CC,BY",
    "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gnu general public license gnu general public license", "Мit License K mit license É mit Élicense", "GPLv3 or later; Copyright © 2020 Me",
    "all rights reserved " * 3000, "mit license " * 5000, "", None, "\x00\x01", "cc", "by cc by",
]


def _brute(text, table):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    base = [(i, label) for p, label in L.PHRASES.items() for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    t = "".join(f" {w} " for w in words)
    found = [(m.start(), m.end(), tier, number, label) for number, label, tier, keyword, regex in table
             if keyword in words for m in re.finditer(regex, t)]
    found.sort(key=lambda s: (s[0], -s[1], s[2], s[3]))
    left, reach = [], dict.fromkeys(L.SCORES, -1)
    for s in found:
        if reach[s[2]] < s[1]:
            left.append(s)
        for tier in L.SCORES:
            if s[2] <= tier:
                reach[tier] = max(reach[tier], s[1])
    tiers = [s[2] for s in left] + ([L.BASE_TIER] if base else [])
    own = sorted({x for _, x in base})
    at = [i for i, _ in base]
    return (len(words), len(base), min(at) if at else None, max(at) if at else None, ",".join(own),
            ",".join(sorted({*own, *(s[4] for s in left)})), L.SCORES[min(tiers)] if tiers else 0.0)


def test_every_rule_holds_its_keyword():
    table = rules()
    assert len(table) > 300 and [r[0] for r in table] == list(range(len(table)))
    for _, _, _, keyword, regex in table:
        while re.search(r"\([^()]*\)\?", regex):
            regex = re.sub(r"\([^()]*\)\?", "", regex)
        assert re.search(rf"(?<![a-z0-9]){keyword}(?![a-z0-9?\[])", regex), regex


def test_matches_brute_force(spark, docs):
    table = rules()
    rows = [r[:2] for r in make_rows()] + [(500 + i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0])] * 2
    extra = spark.createDataFrame([(500 + i, t, 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], 2)] * 2,
                                  "doc_id long, text string, rid int")
    got = L.detect_licenses(docs.unionByName(extra, allowMissingColumns=True)).collect()
    assert Counter(map(tuple, got)) == Counter((d, *_brute(t, table)) for d, t in rows)


def test_suppression_keeps_the_stronger(spark):
    df = spark.createDataFrame([(0, TEXTS[0]), (1, TEXTS[2])], "doc_id long, text string")
    got = {r.doc_id: r for r in L.detect_licenses(df).collect()}
    assert "apache-2.0" in got[0].labels.split(",") and got[0].base_labels == "apache" and got[0].score == 1.0
    assert got[1].labels == "mit" and got[1].n_base == 3
    spans = L.detect_licenses(df.filter("doc_id = 0"), spans=True).collect()
    assert all(not (a.start <= b.start and b.end <= a.end and a.tier <= b.tier) for a in spans for b in spans if a != b)


def test_very_many_matches_stay_linear(spark):
    df = spark.createDataFrame([(0, "mit license cc by " * 30000)], "doc_id long, text string")
    r = L.detect_licenses(df).first()
    assert (r.n_base, r.first_word, r.last_word) == (60000, 0, 119998)


def test_empty_table(spark, no_docs):
    assert L.detect_licenses(no_docs).collect() == []
