"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

``python -m slotwise.check [--sf DIR] [name ...]`` prints one line per query.
Comparison: same column names, same row count, same multiset of rows (values
rendered as text, floats rounded to 6 digits, columns sorted by name).
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{v:.6g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from slotwise.plans import catalog
    catalog.load_all()
    con = duck(sf_dir)
    oracles = catalog.oracles()
    results = {}
    for name, fn in catalog.QUERIES.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:28s} SPARK ERROR {results[name][1]}", flush=True)
            continue
        ts = time.time() - t0
        sql = oracles.get(name)
        if sql is None:
            results[name] = ("no-oracle", len(s_rows))
            if verbose:
                print(f"{name:28s} rows={len(s_rows):7d} (no oracle) {ts:.2f}s", flush=True)
            continue
        try:
            rel = con.sql(sql)
            o_cols = rel.columns
            o_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("oracle-error", str(e).splitlines()[0][:300])
            if verbose:
                print(f"{name:28s} ORACLE ERROR {results[name][1]}", flush=True)
            continue
        ok_cols = sorted(s_cols) == sorted(o_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
        ok = ok_cols and a == b
        results[name] = ("ok" if ok else "mismatch", len(s_rows), len(o_rows))
        if verbose:
            extra = ""
            if not ok:
                if not ok_cols:
                    extra = f" cols spark={s_cols} oracle={o_cols}"
                else:
                    sa, sb = set(a), set(b)
                    extra = f" only-spark={[x for x in a if x not in sb][:2]} only-oracle={[x for x in b if x not in sa][:2]}"
            print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={len(s_rows):7d}/{len(o_rows):7d} {ts:.2f}s{extra}", flush=True)
    return results


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    from slotwise.session import local_session
    spark = local_session()
    res = compare(spark, args.sf, set(args.names) or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "no-oracle")]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
