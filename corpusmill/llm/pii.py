"""Personal data by weak supervision (native).

One scan finds the base spans (email, ip, card, phone) and looser candidates
of the same kinds, on which three labelers vote +1, 0 or -1:

* regex: the strict form of the kind (top-level domain, octets, Luhn, digits);
* gazetteer: known domains, address blocks, card prefixes, dialling codes;
* context: words shortly before the span that speak for or against the kind.

The corpus-wide histogram of (kind, votes, shape) has at most
4 * 27 * 4 rows; expectation-maximisation on it estimates each labeler's
reliability per class, and its posteriors train the final span classifier, a
logistic regression on votes and shape.  The classifier is applied as a
column expression.  Base spans always stay; a candidate that overlaps no base
span is added when the classifier gives it 0.5 or more.

Defined results: a null or empty text has no spans; repeated rows each get
their row; an empty table (or a kind without candidates) trains nothing and
adds nothing; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import apart, match_spans, materialize

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Possessive repeats and the look-behind
# (or "where the last match ended") find the same leftmost matches as the
# plain form, without its quadratic restarts and deep recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Fa-f.:])(?:[0-9]{1,3}(?:[.,][0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f.:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:(?:\+|00)?[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
# What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@|[(\\[]at[)\\]]", "ip": "[0-9A-Fa-f][.,:][0-9A-Fa-f]", "card": "[0-9]", "phone": "[0-9]"}

TLDS = r"(?i)\.(?:com|org|net|edu|gov|mil|int|info|biz|io|ai|dev|app|eu|uk|us|ca|de|fr|es|it|nl|ch|at|jp|cn|br|mx|in)$"
PRIVATE_IP = r"^(?:0|10|127|169\.254|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
DIAL_CODES = r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
FOR = {
    "email": r"e-?mail|contact|write|reach|send|cc",
    "ip": r"\bip\b|address|host|server|client|login|from",
    "card": r"card|visa|master|amex|credit|debit|pay",
    "phone": r"phone|tel|call|fax|mobile|dial|sms",
}
AGAINST = r"version|isbn|issn|serial|invoice|section|chapter|build|order id"
CONTEXT = 40


def octets_ok(m: Column) -> Column:
    """Every dot-separated part is at most 255, whatever its leading zeros."""
    return ~F.exists(F.split(m, r"\."), lambda p: ~p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """True when the digit string passes the Luhn check."""
    r = F.reverse(d)
    values = F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: F.struct(
        (i % 2 == 0).alias("twice"), F.substr(r, i, F.lit(1)).cast("int").alias("d")))
    total = F.aggregate(values, F.lit(0), lambda a, x: a + F.when(
        x["twice"], 2 * x["d"] - F.when(x["d"] > 4, 9).otherwise(0)).otherwise(x["d"]))
    return F.when(F.length(d) > 0, total % 10 == 0).otherwise(False)


def base_ok(kind: str, m: Column) -> Column:
    n = F.length(digits(m))
    if kind == "ip":
        return octets_ok(m)
    if kind == "card":
        return F.when(n.between(16, 19), luhn(digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def base_spans(text: str, kind: str) -> Column:
    k = KINDS.index(kind)
    ok = F.filter(match_spans(text, BASE[kind]), lambda x: base_ok(kind, x["m"]))
    return F.transform(ok, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def _vote(plus: Column, minus: Column) -> Column:
    return F.when(minus, -1).when(plus, 1).otherwise(0)


def candidates(text: str, kind: str) -> Column:
    """Loose spans of a kind with their votes and shape."""
    k = KINDS.index(kind)

    def judged(x):
        m, d = x["m"], digits(x["m"])
        near = F.lower(x["near"])
        if kind == "email":
            strict, known, unlikely = m.rlike(r"@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), m.rlike(TLDS), ~m.contains(".")
        elif kind == "ip":
            dotted = m.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
            strict, known, unlikely = F.when(dotted, octets_ok(m)).otherwise(m.rlike(r"^(?:[0-9A-Fa-f]+:){7}")), \
                m.rlike(r"^[1-9]"), m.rlike(PRIVATE_IP)
        elif kind == "card":
            strict, known, unlikely = luhn(d), d.rlike(CARD_PREFIX), ~d.rlike(CARD_PREFIX)
        else:
            strict, known, unlikely = F.length(d).between(8, 15), m.rlike(DIAL_CODES), m.rlike(r"^0{3}")
        return F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"),
                        _vote(strict, ~strict).alias("v1"), _vote(known, unlikely).alias("v2"),
                        _vote(near.rlike(FOR[kind]), near.rlike(AGAINST)).alias("v3"),
                        m.rlike(r"[\x20()\[\]-]").cast("int").alias("f1"), (F.length(m) >= 16).cast("int").alias("f2"))

    return F.transform(match_spans(text, LOOSE[kind], CONTEXT), judged)


def expectation_maximisation(hist: list, rounds: int = 60) -> list:
    """Posterior of "personal" for each histogram row (votes, shape, count).

    Dawid-Skene model: labelers are independent given the class, and each
    has its own probability of each vote in each class.  Starts from the
    majority vote; counts are smoothed by one, plus pseudo-counts of 5 % of
    the candidates that say a labeler votes its class more often than not.
    """
    trust = 0.05 * sum(n for _, _, n in hist)
    post = [1 / (1 + math.exp(-2.0 * sum(v))) for v, _, _ in hist]
    for _ in range(rounds):
        prior = (1 + sum(p * n for p, (_, _, n) in zip(post, hist))) / (2 + sum(n for _, _, n in hist))
        like = []
        for c in (0, 1):
            weight = [(p if c else 1 - p) * n for p, (_, _, n) in zip(post, hist)]
            total = sum(weight)
            own = 1 if c else -1
            like.append([{v: (1 + trust * (v == own) + sum(w for w, (vs, _, _) in zip(weight, hist) if vs[j] == v))
                          / (3 + trust + total) for v in (-1, 0, 1)} for j in range(3)])
        for i, (vs, _, _) in enumerate(hist):
            odds = math.log(prior / (1 - prior)) + sum(math.log(like[1][j][v] / like[0][j][v])
                                                       for j, v in enumerate(vs))
            post[i] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return post


def _features(votes, shape) -> list:
    return [1.0, *(float(v == 1) for v in votes), *(float(v == -1) for v in votes), *map(float, shape)]


def fit_classifier(hist: list, post: list, rounds: int = 400, rate: float = 1.0, decay: float = 1e-3) -> list:
    """Logistic regression on the EM posteriors as soft labels."""
    x = [_features(v, s) for v, s, _ in hist]
    total = float(sum(n for _, _, n in hist))
    w = [0.0] * len(x[0])
    for _ in range(rounds):
        grad = [-decay * a for a in w]
        for f, p, (_, _, n) in zip(x, post, hist):
            z = max(-30.0, min(30.0, sum(a * b for a, b in zip(w, f))))
            err = (p - 1 / (1 + math.exp(-z))) * n / total
            grad = [g + err * b for g, b in zip(grad, f)]
        w = [a + rate * g for a, g in zip(w, grad)]
    return w


def _score(c: Column, w: list) -> Column:
    votes = (c["v1"], c["v2"], c["v3"])
    z = F.lit(w[0])
    for j, v in enumerate(votes):
        z = z + F.when(v == 1, w[1 + j]).when(v == -1, w[4 + j]).otherwise(0.0)
    return z + c["f1"] * F.lit(w[7]) + c["f2"] * F.lit(w[8])


def train(cands: DataFrame) -> dict:
    """Classifier weights per kind from the vote histogram of all candidates."""
    rows = cands.groupBy("k", "v1", "v2", "v3", "f1", "f2").agg(F.count(F.lit(1)).alias("n")).collect()
    model = {}
    for k in range(len(KINDS)):
        hist = sorted(((r.v1, r.v2, r.v3), (r.f1, r.f2), r.n) for r in rows if r.k == k)
        if hist:
            model[k] = fit_classifier(hist, expectation_maximisation(hist))
    return model


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, base and added spans as (k, s, e) arrays.

    ``k`` indexes ``KINDS``; offsets are code points, end exclusive.  Base
    spans are ordered by kind, then start.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def spans_of(find):
        return F.flatten(F.array_compact(F.array(*[F.when(F.col("text").rlike(NEEDS[k]), find("text", k)) for k in KINDS])))

    rows = materialize(src.select("doc_id", spans_of(base_spans).alias("base"), spans_of(candidates).alias("cands")), "pii")
    model = train(rows.select(F.explode("cands").alias("c")).select("c.*"))

    def accepted(c):
        yes = F.lit(False)
        for k, w in model.items():
            yes = F.when(c["k"] == k, _score(c, w) >= 0.0).otherwise(yes)
        return yes

    kind = rows.schema["cands"].dataType.elementType.simpleString()
    added = F.transform(apart(F.filter("cands", accepted), F.col("base"), kind), lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e")))
    return rows.select("doc_id", "base", added.alias("added"))


def joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(name, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest_columns(found: DataFrame) -> DataFrame:
    def n_of(k):
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")

    count = [n_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
