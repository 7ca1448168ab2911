"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and the multiset of rows (columns sorted by
name, floats compared after rounding to 9 significant digits).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import importlib
    entry = importlib.import_module("__spark_entry__")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            scols, srows = spark_rows(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            out[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, out[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            out[name] = f"rows-only {len(srows)}"
            if verbose:
                print(f"{name:28s} {out[name]} ({ts:.1f}s)", flush=True)
            continue
        try:
            dcols, drows = duck_rows(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            out[name] = f"SQL ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, out[name], flush=True)
            continue
        key = lambda r: tuple(str(x) for x in r)
        if scols != dcols:
            res = f"COLUMNS differ spark={scols} duck={dcols}"
        elif len(srows) != len(drows):
            res = f"ROWCOUNT spark={len(srows)} duck={len(drows)}"
        elif sorted(srows, key=key) != sorted(drows, key=key):
            a, b = sorted(srows, key=key), sorted(drows, key=key)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            res = f"VALUES differ e.g. {diff}"[:1500]
        else:
            res = f"ok {len(srows)} rows"
        out[name] = res
        if verbose:
            print(f"{name:28s} {res} ({ts:.1f}s)", flush=True)
    return out


if __name__ == "__main__":
    from strata.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
