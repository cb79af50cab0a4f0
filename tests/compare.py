"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py sf0.01 [name …]``."""

import glob
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    mine = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    theirs = canonical([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    a, b = set(mine[1]), set(theirs[1])
    return f"rows {len(mine[1])} vs {len(theirs[1])}; only here {list(a - b)[:2]}; only SQL {list(b - a)[:2]}"


if __name__ == "__main__":
    from alertloom.plans.oracle import ORACLE
    from alertloom.plans.queries import QUERIES
    from alertloom.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sys.argv[1]}"
    con = oracle(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                result = difference(df, con, ORACLE[name]) or "ok"
            else:
                result = f"rows {df.count()}"
        except Exception as e:
            result = f"ERROR {type(e).__name__} {str(e)[:700]}"
        print(f"\n{name:22s} {time.time() - started:6.2f}s {result[:900]}", flush=True)
