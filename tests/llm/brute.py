"""Plain-Python versions of the contracts, straight from their wording."""

import hashlib
import re

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def sha(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def pii(text):
    t = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) if "@" in t else ():
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m.group(0).split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group(0))
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m.group(0))) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def secrets(text):
    t = text or ""
    out = []
    p = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for m in p.finditer(t):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", t):
        if len(m.group(0)) >= 18:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", t):
        if len(m.group(0)) >= 16:
            out.append((m.start(), 2, "hex", m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def join(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def exact_groups(rows):
    """doc_id, keep_id, size, hash per row (rows: doc_id, text)."""
    groups = {}
    for d, t in rows:
        h = sha(re.sub(r"[\x20\x09-\x0D]", "", t or ""))
        groups.setdefault(h, []).append((-len(t or ""), d is None, d or 0, d))
    return {h: (min(g)[3], len(g)) for h, g in groups.items()}


def shingles(text, n=5):
    t = re.sub("[A-Z]+", lambda m: m.group(0).lower(), text or "")
    w = words(t)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def components(rows):
    """doc_id -> (set size, smallest linked doc_id), by all pairs."""
    sets = [(d, shingles(t)) for d, t in rows]
    comp = {d: d for d, _ in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, (a, sa) in enumerate(sets):
        for b, sb in sets[:i]:
            if sa and sb and 100 * len(sa & sb) >= 75 * len(sa | sb):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets}


def repeats(rows, n=35):
    """doc_id -> (n_words, n_removed, kept hash), by counting every window."""
    seen = {}
    for _, t in rows:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            seen[k] = seen.get(k, 0) + 1
    out = {}
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out
