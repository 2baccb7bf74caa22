"""Compare registered queries with their DuckDB twins.

usage: python tools/check.py [--sf DIR] [--module plans.module] [name ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lumenframe.plans import registry  # noqa: E402
from lumenframe.runtime import session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(v):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    return v


def kind(v):
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def key(row):
    return tuple((x is None, type(x).__name__, repr(x)) for x in row)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--module", action="append")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    if a.module:
        for m in a.module:
            importlib.import_module(f"lumenframe.plans.{m}")
    else:
        importlib.import_module("lumenframe.plans")
    spark = session("check", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{a.sf}/{t}.parquet'")
    names = a.names or list(registry.QUERIES)
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = registry.QUERIES[name](spark, a.sf)
            cols = sorted(df.columns)
            got = [tuple(plain(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
            took = time.time() - t0
            if name not in registry.ORACLE:
                print(f"ROWS {name:32s} {len(got):7d} rows {took:6.1f}s", got[:1] if a.names else "")
                if not got:
                    bad.append(name)
                continue
            rel = con.sql(registry.ORACLE[name])
            names_ok = sorted(rel.columns) == cols
            want = []
            order = [rel.columns.index(c) for c in cols] if names_ok else range(len(rel.columns))
            for r in rel.fetchall():
                want.append(tuple(plain(r[i]) for i in order))
            got.sort(key=key)
            want.sort(key=key)
            kinds = [
                (c, sorted({kind(r[i]) for r in got}), sorted({kind(r[i]) for r in want}))
                for i, c in enumerate(cols)
            ] if names_ok else []
            off = [k for k in kinds if set(k[1]) - {"NoneType"} != set(k[2]) - {"NoneType"}]
            ok = names_ok and got == want and not off
            print(f"{'OK  ' if ok else 'DIFF'} {name:32s} {len(got):7d} rows {took:6.1f}s", flush=True)
            if not ok:
                bad.append(name)
                if not names_ok:
                    print("   columns", cols, sorted(rel.columns))
                print("   counts", len(got), len(want), "kinds", off)
                shown = 0
                for g, w in zip(got, want):
                    if g != w and shown < 3:
                        print("   spark ", str(g)[:400])
                        print("   duckdb", str(w)[:400])
                        shown += 1
        except Exception as exc:
            bad.append(name)
            print(f"FAIL {name}: {type(exc).__name__} {chr(10).join(str(exc).splitlines()[:4])[:900]}")
            if a.names and len(a.names) < 3:
                traceback.print_exc(limit=8)
    print("bad:", bad)


if __name__ == "__main__":
    main()
