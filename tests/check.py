"""Run registered queries against their check SQL: ``python tests/check.py [sf] [name part ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import tempfile
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return (v if os.environ.get("STRICT") else round(v, 5)) + 0.0
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(df, con, sql):
    cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    ocols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns differ: {sorted(set(cols) ^ set(ocols))}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}", len(got)
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            diff = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y or type(x) is not type(y)]
            return f"values differ: {diff[:4]}", len(got)
    return None, len(got)


def connect(sf_dir):
    import duckdb

    from medtable.sources.star import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def session(cpus="8"):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("medtable").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="medtable-tests-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf="0.01", *parts):
    from medtable.plans.catalog import ORACLES, QUERIES
    spark, sf_dir = session(), f"/root/testdata/sf{sf}"
    con, bad = connect(sf_dir), []
    for name, fn in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                error, n = compare(df, con, ORACLES[name])
            else:
                error, n = None, len(df.collect())
        except Exception as e:
            error, n = f"{type(e).__name__}: {str(e)[:700]}", -1
            if os.environ.get("TRACE"):
                traceback.print_exc()
        mark = "FAIL" if error else ("ok" if name in ORACLES else "rows")
        print(f"{mark:5s}{name:45s}{n:8d} rows {time.time() - start:6.2f}s  {error or ''}", flush=True)
        if error:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
