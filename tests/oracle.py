"""Compare registered queries with their SQL on DuckDB. Also a script: ``python tests/oracle.py SF_DIR [names..]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def build_session(cores: str = "8", tmp: str | None = None):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("funnelbook")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    if tmp:
        builder = builder.config("spark.checkpoint.dir", tmp).config("spark.sql.warehouse.dir", f"{tmp}/warehouse")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str):
    import duckdb

    from funnelbook.registry.base import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, bool):
        return v
    return int(v) if isinstance(v, int) else v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf: str):
    """(ok, message)"""
    from funnelbook.registry import ORACLES, QUERIES

    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return True, f"{sum(got.values())} rows, no SQL"
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        return False, f"{sum(got.values())} vs {sum(want.values())} rows; only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    return True, f"{sum(got.values())} rows"


if __name__ == "__main__":
    import tempfile

    from funnelbook.registry import QUERIES

    sf = sys.argv[1]
    spark, con = build_session(tmp=tempfile.mkdtemp(prefix="run-", dir="/tmp")), duck(sf)
    bad = 0
    for name in sys.argv[2:] or sorted(QUERIES):
        t = time.time()
        try:
            ok, message = compare(spark, con, name, sf)
        except Exception as e:  # noqa: BLE001
            ok, message = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", f"{time.time() - t:6.2f}s", name, message, flush=True)
    print("failures:", bad)
