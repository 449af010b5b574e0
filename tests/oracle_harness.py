"""Spark-vs-DuckDB comparison, the way the correctness gate does it.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v if v is None else str(v)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    ok_cols = sorted(s_cols) == sorted(d_cols)
    detail = ""
    if ok_cols:
        order = [d_cols.index(c) for c in s_cols]
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
        key = lambda r: tuple("" if x is None else str(x) for x in r)
        s_sorted, d_sorted = sorted(s_rows, key=key), sorted(d_rows, key=key)
        same = s_sorted == d_sorted
        if not same:
            ss, ds = set(s_sorted), set(d_sorted)
            detail = f" spark-only={list(ss - ds)[:3]} duck-only={list(ds - ss)[:3]}"
    else:
        same = False
        detail = f" cols spark={s_cols} duck={d_cols}"
    status = "OK " if same and len(s_rows) == len(d_rows) else "BAD"
    print(f"{status} {name}: spark={len(s_rows)} duck={len(d_rows)} ({t1 - t0:.1f}s){detail}", flush=True)
    return status == "OK "


def main(argv):
    import __spark_entry__ as entry
    from demandlake.session import build_session

    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    con = duck(sf_dir)  # before the JVM starts: connecting afterwards can stall
    spark = build_session("local[8]", 8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = []
    for name in names or list(qs):
        if name not in oracle:
            df = qs[name](spark, sf_dir)
            print(f"-- {name}: no oracle, rows={df.count()}", flush=True)
            continue
        try:
            if not compare(spark, con, name, qs[name], oracle[name], sf_dir):
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
