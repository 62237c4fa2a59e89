"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [--sf DIR] [key ...]

Prints one line per key: OK / MISMATCH / ERROR / NO-ORACLE with row counts.
Comparison: same column names, same row count, and the same multiset of
rows with columns sorted by name (floats compared exactly and, as a
fallback, to 1e-9 relative).
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v, tol):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if tol:
            return float(f"{v:.9g}")
        return v
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return norm(v.item(), tol)
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, tol)) for k, x in v.items()))
    return v


def rows_of(cols, rows, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i], tol) for i in order) for r in rows), key=repr)


def check(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return "NO-ORACLE", f"spark_rows={len(srows)} {ts:.1f}s"
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    if sorted(scols) != sorted(dcols):
        return "MISMATCH", f"cols spark={sorted(scols)} duck={sorted(dcols)}"
    tmap = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
            "TIMESTAMP": "timestamp_ntz", "DATE": "date", "FLOAT": "float", "SMALLINT": "smallint"}
    st = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = {d[0]: tmap.get(str(d[1]), str(d[1])) for d in cur.description}
    tdiff = {c: (st[c], dtypes[c]) for c in scols if st[c] != dtypes[c]}
    if len(srows) != len(drows):
        return "MISMATCH", f"rows spark={len(srows)} duck={len(drows)}"
    # align duck columns to spark order
    idx = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in idx) for r in drows]
    tnote = f" TYPES {tdiff}" if tdiff else ""
    if rows_of(scols, srows, False) == rows_of(scols, drows, False):
        return "OK", f"rows={len(srows)} {ts:.1f}s{tnote}"
    a, b = rows_of(scols, srows, True), rows_of(scols, drows, True)
    if a == b:
        return "OK~", f"rows={len(srows)} (1e-9) {ts:.1f}s"
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return "MISMATCH", f"rows={len(srows)} values differ, cols={sorted(scols)} e.g. {diff}"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from gridlens.session import get_session
    from gridlens.plans.registry import load_all
    Q, O = load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(a.sf)
    keys = a.keys or sorted(Q)
    bad = 0
    for k in keys:
        try:
            st, msg = check(spark, con, k, Q[k], O.get(k), a.sf)
        except Exception as e:  # noqa: BLE001
            st, msg = "ERROR", str(e).split("\n")[0][:300]
        if st in ("MISMATCH", "ERROR"):
            bad += 1
        print(f"{st:10s} {k:32s} {msg}", flush=True)
    print(f"# {len(keys) - bad}/{len(keys)} ok")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
