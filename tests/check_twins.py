"""Run registered queries beside their SQL twins: python tests/check_twins.py [regex] [sf_dir]."""

from __future__ import annotations

import datetime
import decimal
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from tabularium.catalog import load_all
from tabularium.session import local_session
from tabularium.tables import TABLE_NAMES


def cell(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return "DEC" + repr(float(v))
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cross_joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin") if w in plan]


def compare(spark, con, name, q, sf_dir):
    """None when both sides agree, else what differs."""
    df = q(spark, sf_dir)
    if cross_joins(df):
        return f"plan has {cross_joins(df)}", 0
    rows = [tuple(r) for r in df.collect()]
    if q.sql is None:
        return None, len(rows)
    cur = con.execute(q.sql)
    columns = [d[0] for d in cur.description]
    expected = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(rows)
    a, b = table(df.columns, rows), table(columns, expected)
    if a != b:
        extra = [r for r in a if r not in set(b)][:3]
        missing = [r for r in b if r not in set(a)][:3]
        return f"rows {len(a)} vs {len(b)}; {sorted(columns)}\n   spark {extra}\n   sql   {missing}", len(rows)
    return None, len(rows)


def main():
    pattern = re.compile(sys.argv[1] if len(sys.argv) > 1 else ".")
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    if os.environ.get("TWINS_PLAIN"):  # a session with Spark's own settings
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = []
    for name, q in load_all().items():
        if not pattern.search(name):
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:900]}", -1
        took = time.time() - start
        flag = "FAIL" if problem else ("rows" if q.sql is None else "ok")
        if problem:
            bad.append(name)
        print(f"{flag:5}{name:36}{n:8}{took:7.2f}s {problem or ''}", flush=True)
    print("FAILED", bad)
    spark.stop()


if __name__ == "__main__":
    main()
