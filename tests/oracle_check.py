"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Row count, column names and an order-insensitive multiset of rows are compared.
"""
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cols = df.columns
    t1 = time.time()
    if sql is None:
        return dict(key=key, ok=None, rows=len(rows), sec=round(t1 - t0, 2), note="no oracle")
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    ok_cols = sorted(cols) == sorted(ocols)
    ok_n = len(rows) == len(orows)
    ok_v = ok_cols and canon(cols, rows) == canon(ocols, orows)
    note = ""
    if not ok_cols:
        note = f"cols spark={sorted(cols)} oracle={sorted(ocols)}"
    elif not ok_v:
        a, b = canon(cols, rows), canon(ocols, orows)
        sa, sb = set(a), set(b)
        diff = [x for x in a if x not in sb][:2]
        diffb = [x for x in b if x not in sa][:2]
        note = f"spark-only={diff} oracle-only={diffb}"
    return dict(key=key, ok=ok_cols and ok_n and ok_v, rows=len(rows), orows=len(orows),
                sec=round(t1 - t0, 2), note=note)


def main():
    from pyspark.sql import SparkSession
    import tempfile
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-check-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry
    qs, os_ = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in (keys or sorted(qs)):
        try:
            r = compare(spark, con, k, qs[k], os_.get(k), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(key=k, ok=False, note=f"ERROR {type(e).__name__}: {str(e)[:300]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad} of {len(keys or qs)}")


if __name__ == "__main__":
    main()
