"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]

Compares row count, column names/types and the multiset of rows (floats to
9 significant digits, everything else exactly).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: {len(srows)} rows (no oracle) {t1 - t0:.2f}s"
    rel = con.sql(sql)
    dcols = list(rel.columns)
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    drows_raw = rel.fetchall()
    if sorted(dcols) != cols:
        return False, f"{name}: columns differ spark={cols} duck={sorted(dcols)}"
    stypes = dict(sdf.dtypes)
    bad = [(c, stypes[c], dtypes[c]) for c in cols if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]]
    if bad:
        return False, f"{name}: types differ (column, spark, duckdb): {bad}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    if len(srows) != len(drows):
        return False, f"{name}: rows spark={len(srows)} duck={len(drows)}"
    a = sorted(srows, key=_key)
    b = sorted(drows, key=_key)
    for ra, rb in zip(a, b):
        if ra != rb:
            diff = [(c, x, y) for c, x, y in zip(cols, ra, rb) if x != y]
            return False, f"{name}: first differing row: {diff[:6]}"
    return True, f"{name}: {len(srows)} rows equal ({t1 - t0:.2f}s spark)"


def main(argv: list[str]) -> int:
    from quayside.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import queries

    names = argv[2:] or list(queries())
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("OK   " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
