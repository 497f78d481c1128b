"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive value hash (the driver's
check).  Usage: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from vaultspark.sources.fixtures import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def check(spark, sf_dir, names=None):
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:400])
            continue
        ts = time.time() - t
        if name not in sqls:
            results[name] = ("NO-ORACLE", len(rows), round(ts, 1))
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e)[:400])
            continue
        ok = (sorted(cols) == sorted(ocols) and len(rows) == len(orows)
              and digest(cols, rows) == digest(ocols, orows))
        results[name] = ("OK" if ok else "MISMATCH", len(rows), len(orows), round(ts, 1),
                         None if sorted(cols) == sorted(ocols) else (cols, ocols))
    return results


if __name__ == "__main__":
    from vaultspark import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", 8)
    for k, v in check(spark, sf, names).items():
        print(k, v, flush=True)
