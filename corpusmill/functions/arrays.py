"""Row generation from arrays without re-evaluating the array.

An inner ``explode``/``posexplode`` lets Catalyst infer ``size(arr) > 0``
(InferFiltersFromGenerate) and push that filter below projections and
exchanges, where it evaluates the whole array expression a second time (for
sentence extraction or detection: on the scan's tasks, before the data is
spread).  ``posexplode_outer`` infers nothing; empty arrays give one row
with a NULL position, which is dropped right after the generator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def posexplode_rows(df: DataFrame, keep: list, arr: Column, pos: str = "pos",
                    value: str = "value") -> DataFrame:
    """``posexplode`` semantics (no row for an empty or NULL array)."""
    return (df.select(*keep, F.posexplode_outer(arr).alias(pos, value))
            .where(F.col(pos).isNotNull()))


def explode_rows(df: DataFrame, keep: list, arr: Column, value: str = "value") -> DataFrame:
    """``explode`` semantics (no row for an empty or NULL array)."""
    return posexplode_rows(df, keep, arr, "_pos", value).drop("_pos")


# Elements that a fold appends to one array; see ``scan_array``.
_CHUNK, _BIG = 256, 1 << 16


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _slices(arr: Column, size: int) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(arr) - 1) / size).cast("int"), F.lit(0)))
    return F.transform(starts, lambda i: F.slice(arr, i * size + 1, F.lit(size)))


def chunks(arr: Column) -> Column:
    """array<array<T>>: ``arr`` in pieces of ``_CHUNK`` elements.  An empty array
    is one empty piece; a NULL array gives NULL."""
    return let(arr, lambda a: F.when(F.size(a) <= _CHUNK, F.array(a)).otherwise(
        F.flatten(F.transform(_slices(a, _BIG), lambda b: _slices(b, _CHUNK)))))


def scan_array(arr: Column, state: Column, step, out_type: str, finish=None) -> Column:
    """A left fold that emits elements: ``step(state, x) -> (state, array to append)``.

    Gives array<out_type>, or ``finish(state, emitted)``.  Appending to an array copies it, which is
    quadratic in a plain fold; here a fold appends within a piece of ``_CHUNK``
    elements only, and whole pieces are flattened at the end.
    """
    none = F.array().cast(f"array<{out_type}>")

    def inner(acc, x):
        st, emitted = step(acc["st"], x)
        return F.struct(st.alias("st"), F.concat(acc["out"], emitted).alias("out"))

    def outer(acc, piece):
        return F.aggregate(piece, F.struct(acc["st"].alias("st"), none.alias("out")), inner, lambda a: F.struct(
            a["st"].alias("st"), F.concat(acc["outs"], F.array(a["out"])).alias("outs")))

    start = F.struct(state.alias("st"), F.array().cast(f"array<array<{out_type}>>").alias("outs"))
    done = finish or (lambda st, out: out)
    return F.aggregate(chunks(arr), start, outer, lambda a: done(a["st"], F.flatten(a["outs"])))


def sql_string(text: str) -> str:
    """A SQL string literal of ``text``."""
    out = text.replace("\\", "\\\\").replace("'", "\\'").replace("\x00", "\\u0000")
    return f"'{out}'"


def scan_sql(arr: str, state: str, next_state: str, emit: str, out_type: str) -> str:
    """``scan_array`` as SQL text: one call instead of hundreds to build an expression.

    ``next_state`` and ``emit`` name the state ``a.st`` and the element ``x``; ``emit`` is
    an array<out_type> or NULL for nothing.
    """
    none = f"cast(array() AS array<{out_type}>)"

    def cut(of: str, size: int) -> str:
        return f"transform(sequence(0, int((size({of}) - 1) / {size})), i -> slice({of}, i * {size} + 1, {size}))"

    pieces = (f"transform(array({arr}), w -> if(size(w) <= {_CHUNK}, array(w), "
              f"flatten(transform({cut('w', _BIG)}, b -> {cut('b', _CHUNK)}))))[0]")
    return (f"aggregate({pieces}, named_struct('st', {state}, 'outs', cast(array() AS array<array<{out_type}>>)), "
            f"(acc, piece) -> aggregate(piece, named_struct('st', acc.st, 'out', {none}), "
            f"(a, x) -> named_struct('st', {next_state}, 'out', concat(a.out, coalesce({emit}, {none}))), "
            f"a -> named_struct('st', a.st, 'outs', concat(acc.outs, array(a.out)))), a -> flatten(a.outs))")
