"""Run registered queries against their DuckDB oracles (row count, column
names, order-insensitive values).  Usage:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, sf_dir, name, query, sql, con):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = "COLUMNS"
        res["detail"] = {"spark": s_cols, "oracle": d_cols}
        return res
    a = sorted((tuple(r[i] for i in order_s) for r in s_rows), key=_key)
    b = sorted((tuple(r[i] for i in order_d) for r in d_rows), key=_key)
    if a == b:
        res["status"] = "OK"
    else:
        res["status"] = "VALUES"
        sa, sb = set(a), set(b)
        res["detail"] = {"only_spark": [list(x) for x in list(sa - sb)[:3]],
                         "only_oracle": [list(x) for x in list(sb - sa)[:3]],
                         "cols": sorted(s_cols)}
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from quarry.session import build_session

    if os.environ.get("PLAIN_SESSION"):
        # The driver's own session: Spark defaults, nothing of ours.
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", 8)
    import __spark_entry__ as e

    qs, os_ = e.queries(), e.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in os_:
            print(json.dumps({"name": name, "status": "NO_ORACLE"}), flush=True)
            continue
        try:
            r = compare(spark, sf_dir, name, q, os_[name], con)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": repr(exc)[:800]}
        bad += r["status"] != "OK"
        print(json.dumps(r, default=str), flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
