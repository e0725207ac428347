"""Compare named Spark queries with their DuckDB oracle, as the driver does:
row count, column names, and an order-insensitive hash of the values.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, bytes):
        return v.hex()
    return str(v)


def table_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, sf_dir, name, fn, sql, con):
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sh, sl = table_hash(s_cols, s_rows)
    dh, dl = table_hash(d_cols, d_rows)
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and sh == dh
    info = {"name": name, "ok": ok, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
            "spark_cols": sorted(s_cols), "oracle_cols": sorted(d_cols), "spark_sec": round(t_spark, 2)}
    if not ok:
        missing = sorted(set(dl) - set(sl))[:3]
        extra = sorted(set(sl) - set(dl))[:3]
        info["only_oracle"] = missing
        info["only_spark"] = extra
    return info


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from riskflow.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    if os.environ.get("PLAIN_SESSION"):
        # as a driver might: Spark defaults only (200 shuffle partitions)
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in os_:
            t = time.time()
            n = fn(spark, sf_dir).count()
            print({"name": name, "rows_only": n, "spark_sec": round(time.time() - t, 2)})
            continue
        info = compare(spark, sf_dir, name, fn, os_[name], con)
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
