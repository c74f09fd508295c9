"""Compare registered queries with their DuckDB oracles (rows, column names, values).

Usage: python tests/oracle_check.py [--plain] [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    s_cols, s_rows = rows_of_spark(fn(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = rows_of_duck(con, sql)
    ok = s_cols == d_cols and s_rows == d_rows
    detail = ""
    if not ok:
        if s_cols != d_cols:
            detail = f"cols spark={s_cols} duck={d_cols}"
        else:
            miss = [r for r in d_rows if r not in set(s_rows)][:3]
            extra = [r for r in s_rows if r not in set(d_rows)][:3]
            detail = f"rows spark={len(s_rows)} duck={len(d_rows)} missing={miss} extra={extra}"
    return ok, len(s_rows), t1 - t0, detail


def main(argv):
    plain = "--plain" in argv      # a bare session, as a caller might hand in
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    import __spark_entry__ as entry
    from playtally.session import build_session

    if plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
                 .getOrCreate())
    else:
        spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        ok, n, secs, detail = compare(spark, con, name, fn, sqls[name], sf_dir)
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n:<7d} {secs:6.2f}s {detail}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
