"""Run registered Spark queries and their DuckDB SQL side by side.

    python scripts/oracle_check.py [/root/testdata/sf0.01] [name ...]

Compares row count, column names and an order-insensitive multiset of
values (floats rounded to 6 digits).  Prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from corpusmill.plans import registry  # noqa: E402
from corpusmill.session import checkpoint_dir, local_session  # noqa: E402
from corpusmill.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return repr(round(v, 6))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, int):
        return repr(v)
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    out = sorted(tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))
    return cols, out


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    registry.load_all()
    names = args or list(registry.QUERIES)
    spark = local_session(8)
    checkpoint_dir(spark)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sp = registry.QUERIES[n](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{n:24s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = registry.ORACLE.get(n)
        if sql is None:
            print(f"{n:24s} rows={len(sp)} (no oracle) spark={ts:.1f}s")
            continue
        try:
            dd = con.sql(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"{n:24s} DUCKDB-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        c1, r1 = rows(sp)
        c2, r2 = rows(dd)
        ok = c1 == c2 and r1 == r2
        bad += not ok
        msg = "OK " if ok else "DIFF"
        print(f"{n:24s} {msg} rows={len(r1)}/{len(r2)} spark={ts:.1f}s")
        if not ok:
            if c1 != c2:
                print("   cols", c1, c2)
            else:
                s1, s2 = set(r1), set(r2)
                for r in list(s1 - s2)[:3]:
                    print("   spark-only", str(r)[:400])
                for r in list(s2 - s1)[:3]:
                    print("   duck-only ", str(r)[:400])
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
