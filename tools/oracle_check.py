"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of rows
(columns sorted by name).  Exit code 1 on any mismatch.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime as dt
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    out = []
    for r in rel.fetchall():
        vals = []
        for i in idx:
            v = r[i]
            # DuckDB REAL arrives as a Python float of the float32 value
            vals.append(_norm(v))
        out.append(tuple(vals))
    return cols, out


def compare(spark, sf_dir, names=None, verbose=True):
    from collections import Counter
    from emberlog.catalog import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name in names or list(qs):
        t0 = time.time()
        try:
            sc, sr = rows_spark(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"ROWS {name}: {len(sr)} rows (no oracle) {t1 - t0:.1f}s")
            continue
        dc, dr = rows_duck(con, sqls[name])
        ok = sc == dc and Counter(sr) == Counter(dr)
        msg = f"{'ok  ' if ok else 'FAIL'} {name}: spark {len(sr)} rows, oracle {len(dr)} rows, {t1 - t0:.1f}s"
        print(msg)
        if not ok:
            bad.append(name)
            if sc != dc:
                print("   columns spark :", sc)
                print("   columns oracle:", dc)
            else:
                a, b = Counter(sr), Counter(dr)
                only_s = list((a - b).elements())[:3]
                only_d = list((b - a).elements())[:3]
                for x in only_s:
                    print("   spark only :", dict(zip(sc, x)))
                for x in only_d:
                    print("   oracle only:", dict(zip(dc, x)))
    return bad


if __name__ == "__main__":
    from emberlog.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    bad = compare(spark, sf, names)
    print("MISMATCH:", bad)
    sys.exit(1 if bad else 0)
