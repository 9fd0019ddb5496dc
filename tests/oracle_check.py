"""Run registered queries against their DuckDB oracles and report mismatches.

Usage: python tests/oracle_check.py [--plain] [sf_dir] [name ...]

``--plain`` runs the queries in a session with Spark's default settings
(as a caller's own session would be) instead of the library's tuned one.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return json.dumps([norm(x) for x in v])
    if isinstance(v, dict):
        return json.dumps({str(k): norm(x) for k, x in sorted(v.items())})
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: json.dumps(t, default=str))


def check(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    if sql is None:
        return {"name": name, "ok": None, "rows": len(s_rows), "sec": round(t_spark, 2)}
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = res.fetchall()
    result = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(t_spark, 2)}
    if sorted(s_cols) != sorted(d_cols):
        result.update(ok=False, why=f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
        return result
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    if a != b:
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        result.update(ok=False, why=f"values differ; spark-only {diff_a}; oracle-only {diff_b}")
        return result
    result["ok"] = True
    return result


def main():
    import __spark_entry__ as entry
    from lakestream.session import local_session

    args = sys.argv[1:]
    plain = "--plain" in args
    args = [a for a in args if a != "--plain"]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    if plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = check(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue with the next query
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += r.get("ok") is False
        print(json.dumps(r), flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")


if __name__ == "__main__":
    main()
