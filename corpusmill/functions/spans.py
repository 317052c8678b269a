"""Regex match spans as Column expressions, without a UDF.

``regexp_extract_all`` gives the matches and ``split`` with the same pattern
gives the text between them; match ``i`` starts after all earlier gaps and
matches.  One ``scan_array`` carries the running position, so the cost is
near linear in the number of matches.  Offsets are 0-based code points, end
exclusive (what ``length``/``substring`` count).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let, scan_array, scan_sql, sql_string

SPAN_TYPE = "struct<start:bigint,end:bigint,text:string,tag:string>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


MARK = "\x00"


def _with_run(gap: str, mention: str, before: str | None) -> str:
    """``mention`` with the characters of ``before`` that end the gap in front of it."""
    if not before:
        return mention
    return f"concat(reverse(regexp_extract(reverse({gap}), {sql_string(f'^{before}*')}, 0)), {mention})"


def _two_pass_spans(t: str, pattern: str, tag: str, group: int, before: str | None) -> str:
    """Matches from ``regexp_extract_all`` and gaps from ``split``, in one zip."""
    p = sql_string(pattern)
    items = (f"transform(arrays_zip(regexp_extract_all({t}, {p}, 0), regexp_extract_all({t}, {p}, {group}), split({t}, {p}, -1)), "
             f"z -> named_struct('m', z['0'], 'g', {_with_run("z['2']", "z['1']", before)}, 'gap', z['2']))")
    end = "(a.st + coalesce(length(x.gap) + length(x.m), 0))"
    span = f"named_struct('start', {end} - length(x.g), 'end', {end}, 'text', x.g, 'tag', {sql_string(tag)})"
    return scan_sql(items, "0L", end, f"if(x.m IS NULL, NULL, array({span}))", SPAN_TYPE)


def _one_pass_spans(t: str, pattern: str, tag: str, group: int, before: str | None) -> str:
    """One regex pass: mark each mention with ``\x00`` on both sides, split
    on the mark (a literal), and walk the pieces; odd pieces are mentions."""
    mark = sql_string(MARK)
    repl = f"{MARK}$0{MARK}" if not group else f"$1{MARK}${group}{MARK}"
    if before:
        mention = f"transform(array({_with_run('a.st.gap', 'x', before)}), m -> "
        span = f"{mention}named_struct('start', a.st.pos + length(x) - length(m), 'end', a.st.pos + length(x), 'text', m, 'tag', {sql_string(tag)}))"
    else:
        span = f"array(named_struct('start', a.st.pos, 'end', a.st.pos + length(x), 'text', x, 'tag', {sql_string(tag)}))"
    gap = ("", "") if not before else (", 'gap', ''", ", 'gap', if(a.st.odd, '', x)")
    walk = scan_sql(f"split(r, {mark}, -1)", f"named_struct('pos', 0L, 'odd', false{gap[0]})",
                    f"named_struct('pos', a.st.pos + length(x), 'odd', NOT a.st.odd{gap[1]})",
                    f"if(a.st.odd, {span}, NULL)", SPAN_TYPE)
    # Most texts have no mention of a type and are not split.
    return (f"transform(array(regexp_replace({t}, {sql_string(pattern)}, {sql_string(repl)})), "
            f"r -> if(NOT contains(r, {mark}), cast(array() AS array<{SPAN_TYPE}>), {walk}))[0]")


def regex_spans(text, pattern: str, tag: str, group: int = 0, before: str | None = None) -> Column:
    """array<struct<start,end,text,tag>> of the matches of ``pattern`` in the column
    ``text`` (its name, or ``F.col`` of it).

    With ``group > 0`` the match must be group 1 followed by group ``group``
    (a consumed prefix such as a leading space or an honorific) and the
    mention is group ``group``.  With ``before``, a class of characters, the run of them between
    the match before and this one belongs to the mention.  Texts without ``\x00`` take one regex pass;
    the rare text that contains the marker takes the two-pass form.
    """
    t = f"`{text if isinstance(text, str) else text._jc.toString()}`"
    return F.expr(f"CASE WHEN contains({t}, {sql_string(MARK)}) THEN {_two_pass_spans(t, pattern, tag, group, before)} "
                  f"ELSE {_one_pass_spans(t, pattern, tag, group, before)} END")


def context_of(text, span, window: int) -> Column:
    """``window`` characters on each side of a span, lower-cased."""
    t = _col(text)
    left_start = F.greatest(span["start"] - F.lit(window), F.lit(0))
    left = t.substr(left_start + 1, span["start"] - left_start)
    right = t.substr(span["end"] + 1, F.lit(window))
    return F.lower(F.concat(left, F.lit(" "), right))


def covering_spans(spans, priority: dict[str, int]) -> Column:
    """Overlapping spans become one span that covers them all.

    ``spans`` are sorted by start (``sort_spans``).  The cover takes the tag
    of highest priority among its parts, so no character of any mention is
    left outside the result.
    """
    prio = F.create_map(*[x for k, v in priority.items() for x in (F.lit(k), F.lit(v))])

    def rank(tag):
        return F.coalesce(F.try_element_at(prio, tag), F.lit(99))

    none = F.array().cast(f"array<{SPAN_TYPE}>")

    def step(cur, x):
        longer = F.concat(cur["text"], F.substring(x["text"], (cur["end"] - x["start"] + 1).cast("int"),
                                                   F.length(x["text"])))
        merged = F.struct(
            cur["start"].alias("start"), F.greatest(cur["end"], x["end"]).alias("end"),
            F.when(x["end"] > cur["end"], longer).otherwise(cur["text"]).alias("text"),
            F.when(rank(x["tag"]) < rank(cur["tag"]), x["tag"]).otherwise(cur["tag"]).alias("tag"))
        inside = cur.isNotNull() & (x["start"] < cur["end"])
        return (F.when(inside, merged).otherwise(x),
                F.when(cur.isNull() | inside, none).otherwise(F.array(cur)))

    return scan_array(_col(spans), F.lit(None).cast(SPAN_TYPE), step, SPAN_TYPE, lambda cur, out: F.when(
        cur.isNull(), out).otherwise(F.concat(out, F.array(cur))))


def sort_spans(spans, priority: dict[str, int]) -> Column:
    """Total order (start, end desc, tag priority, text); duplicates removed.

    Equal spans are neighbours after sorting, so one pass drops them (comparing all
    pairs, as ``array_distinct`` does for structs, would be quadratic).
    """
    prio = F.create_map(*[x for k, v in priority.items() for x in (F.lit(k), F.lit(v))])
    keyed = F.transform(_col(spans), lambda s: F.struct(
        s["start"].alias("k1"), (-s["end"]).alias("k2"),
        F.coalesce(F.try_element_at(prio, s["tag"]), F.lit(99)).alias("k3"),
        s["text"].alias("k4"), s.alias("s")))
    return let(F.array_sort(keyed), lambda a: F.transform(
        F.filter(a, lambda k, i: (i == 0) | (k != F.get(a, i - 1))), lambda k: k["s"]))
