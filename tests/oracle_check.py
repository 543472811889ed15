"""Run registered queries and their DuckDB oracles side by side.

Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``.  Prints one line
per key: rows (spark/oracle), column-name match, value-multiset match.
``PARITAS_PLAIN_SESSION=1`` uses a default session (no checkpoint folder, the
machine's time zone) instead of ``local_session``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize()  # exactly
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, key, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    st = time.time() - t
    if sql is None:
        return dict(key=key, spark_rows=len(srows), oracle=None, secs=round(st, 2))
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    names_ok = sorted(scols) == sorted(ocols)
    values_ok = names_ok and rows_of(scols, srows) == rows_of(ocols, orows)
    return dict(key=key, spark_rows=len(srows), oracle_rows=len(orows), names=names_ok,
                values=values_ok, secs=round(st, 2), scols=None if names_ok else scols,
                ocols=None if names_ok else ocols)


def main(argv):
    from paritas.session import local_session
    import __spark_entry__ as E

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    if os.environ.get("PARITAS_PLAIN_SESSION"):
        # a session like the driver's: defaults only, no checkpoint folder
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = local_session()
    if os.environ.get("PARITAS_HOT_ROWS"):
        spark.conf.set("spark.paritas.hotKeyRows", os.environ["PARITAS_HOT_ROWS"])
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for key in keys or sorted(qs):
        try:
            r = compare(spark, con, key, qs[key], oracle.get(key), sf_dir)
        except Exception as exc:  # report and continue with the next key
            r = dict(key=key, error=f"{type(exc).__name__}: {str(exc)[:400]}")
        ok = r.get("values", r.get("oracle", 1) is None and "error" not in r)
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} failing of {len(keys or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
