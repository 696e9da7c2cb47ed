"""Run registered queries next to their SQL form and compare rows.

    python tests/oracle_check.py [--sf 0.01] [prefix ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import pathlib
import sys
import time
import traceback

import duckdb

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def types_of(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want_cols, want = rows_of(cols, cur.fetchall())
    if got_cols != want_cols:
        return len(got), f"columns {got_cols} != {want_cols}"
    if got != want:
        only = [r for r in got if r not in set(want)][:3]
        miss = [r for r in want if r not in set(got)][:3]
        return len(got), f"{len(got)} vs {len(want)} rows; only spark {only}; only sql {miss}"
    kinds = dict(zip(cols, [str(d[1]) for d in cur.description]))
    loose = {c: (t, kinds[c]) for c, t in types_of(df).items() if ("decimal" in t) or kinds[c] in ("HUGEINT", "DECIMAL")}
    return len(got), f"types {loose}" if loose else None


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("prefix", nargs="*")
    args = ap.parse_args()
    from clanweave.session import local_session

    entry = importlib.import_module("__spark_entry__")
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con, bad = local_session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        t = time.time()
        try:
            n, err = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            n, err = -1, "".join(traceback.format_exception_only(e))[:700]
        bad += err is not None
        note = "" if name in oracle else " (rows only)"
        print(f"{'FAIL' if err else 'ok'} {name} {n} rows {time.time() - t:.1f}s{note} {err or ''}", flush=True)
    print(f"{bad} failures")
    return bad > 0


if __name__ == "__main__":
    raise SystemExit(main())
