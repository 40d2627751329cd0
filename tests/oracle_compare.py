"""Run a registered query in Spark and its oracle SQL in DuckDB, compare.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows after sorting columns by name. Usage:

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, name: str, sf_dir: str, con=None, verbose=True):
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    sql = E.oracle_sql().get(name)
    if sql is None:
        raise KeyError(f"{name} has no oracle SQL; nothing to compare with")
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    srecs = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.sql(sql)
    dcols = res.columns
    drecs = res.fetchall()
    sc, sr = rows_of(scols, srecs)
    dc, dr = rows_of(dcols, drecs)
    ok = sc == dc and sr == dr
    if verbose:
        print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(sr)} duck={len(dr)} ({t1 - t0:.1f}s)")
        if sc != dc:
            print("   cols spark:", sc, "\n   cols duck: ", dc)
        elif not ok:
            s_only = [r for r in sr if r not in set(dr)][:3]
            d_only = [r for r in dr if r not in set(sr)][:3]
            print("   spark only:", s_only, "\n   duck only: ", d_only)
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from ledgerline.session import local_session
    import __spark_entry__ as E
    spark = local_session(int(__import__("os").environ.get("CPUS", "8")), 8)
    con = duck(sf_dir)
    names = names or list(E.oracle_sql())
    bad = [n for n in names if not compare(spark, n, sf_dir, con)]
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
