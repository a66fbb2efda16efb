"""Driver-like comparison of registered queries with their DuckDB oracle:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(float(v))
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="rows-only", rows=len(s_rows), spark_s=round(t1 - t0, 2))
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    res = dict(name=name, status="ok" if (ok_cols and hs == hd and len(s_rows) == len(d_rows)) else "MISMATCH",
               rows=(len(s_rows), len(d_rows)), spark_s=round(t1 - t0, 2))
    if res["status"] != "ok":
        res["cols"] = (sorted(s_cols), sorted(d_cols)) if not ok_cols else "same"
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        res["only_spark"] = only_s
        res["only_duck"] = only_d
    return res


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from lakestar.session import local_session

    args = list(argv[1:])
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("--sf="):
        sf_dir = f"/root/testdata/sf{args.pop(0).split('=', 1)[1]}"
    names = args or list(E.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), sf_dir)
        except Exception as exc:  # report and continue
            r = dict(name=n, status="ERROR", error=f"{type(exc).__name__}: {str(exc)[:400]}")
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv)
