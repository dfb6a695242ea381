"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names and an order-insensitive value hash.

Usage: python tests/oracle_compare.py [sf_dir] [name,name,...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def digest(columns, rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    hashes = sorted(hashlib.md5("\x1f".join(canon(r[i]) for i in order).encode()).hexdigest() for r in rows)
    return len(rows), hashlib.md5("".join(hashes).encode()).hexdigest()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, dict]:
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec = {}
        try:
            t0 = time.time()
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            rec["spark_sec"] = round(time.time() - t0, 2)
            if name in sqls:
                res = con.execute(sqls[name])
                dcols = [d[0] for d in res.description]
                drows = res.fetchall()
                rec["cols_match"] = sorted(scols) == sorted(dcols)
                sd, dd = digest(scols, srows), digest(dcols, drows)
                rec["rows"] = (sd[0], dd[0])
                rec["hash_match"] = sd == dd and rec["cols_match"]
                if not rec["hash_match"]:
                    rec["diff"] = _diff(scols, srows, dcols, drows)
            else:
                rec["rows"] = (len(srows), None)
        except Exception as ex:  # report and go on
            rec["error"] = str(ex)[:2000]
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


def _diff(scols, srows, dcols, drows, k=3):
    if sorted(scols) != sorted(dcols):
        return {"spark_cols": scols, "duck_cols": dcols}
    order_s = sorted(range(len(scols)), key=lambda i: scols[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    names = [scols[i] for i in order_s]
    a = {tuple(canon(r[i]) for i in order_s) for r in srows}
    b = {tuple(canon(r[i]) for i in order_d) for r in drows}
    only_s, only_d = sorted(a - b)[:k], sorted(b - a)[:k]
    bad = set()
    for x, y in zip(only_s, only_d):
        bad |= {names[i] for i in range(len(names)) if x[i] != y[i]}
    return {"cols": sorted(bad), "spark_only": only_s, "duck_only": only_d}


if __name__ == "__main__":
    from martwise.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if not r.get("hash_match") and ("error" in r or "hash_match" in r)]
    print("MISMATCH/ERROR:", bad)
