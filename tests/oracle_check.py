"""Run registered queries next to their DuckDB oracles and compare.

Compares column names, row count and the multiset of rows (values rendered
canonically). Usable from pytest and as a script:

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<null>"
        return repr(round(v, 6))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _cell(v.item())
    if v is pd.NaT:
        return "<null>"
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_cell(x) for x in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(out)


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    s = queries()[key](spark, sf_dir).toPandas()
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(key)
    if sql is None:
        res["status"] = "rows-only"
        return res
    d = con.execute(sql).df()
    res["oracle_rows"] = len(d)
    if sorted(s.columns) != sorted(d.columns):
        res["status"] = f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
        return res
    rs, rd = rows(s), rows(d)
    if rs == rd:
        res["status"] = "match"
    else:
        a, b = set(rs), set(rd)
        res["status"] = "values differ"
        res["only_spark"] = list(a - b)[:3]
        res["only_oracle"] = list(b - a)[:3]
    return res


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    if os.environ.get("PLAIN_SESSION"):
        # as a caller with nothing but the environment's defaults would
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from tillflow.session import get_session

        spark = get_session("local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
        spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("CHECK_ENTRY"):
        from __spark_entry__ import entry

        e = entry(spark)
        print({"entry_rows": e.count(), "entry_columns": e.columns}, flush=True)
    from __spark_entry__ import queries

    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(queries()):
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"key": k, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} not matching")
