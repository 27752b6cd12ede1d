"""Run a query on Spark and its SQL on DuckDB, and compare the rows as bags.

``python -m tests.oracle /root/testdata/sf0.01 [key ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from weftgraph.plans.star_schema import TABLES


def session(cores: str = "8") -> SparkSession:
    # Python workers import the library too, wherever the tests are started.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH")]))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weftgraph")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, folder: str, query, sql: str) -> tuple[int, str]:
    """(rows, "" or what differs)."""
    df = query(spark, folder)
    mine = _bag(df.collect(), df.columns)
    cur = database(folder).execute(sql)
    names = [d[0] for d in cur.description]
    theirs = _bag(cur.fetchall(), names)
    total = sum(mine.values())
    if sorted(df.columns) != sorted(names):
        return total, f"columns {sorted(df.columns)} / {sorted(names)}"
    if mine != theirs:
        only = list((mine - theirs).items())[:2], list((theirs - mine).items())[:2]
        return total, f"{total} / {sum(theirs.values())} rows; only here, only there: {only}"
    return total, ""


def types_of(df) -> dict[str, str]:
    return dict(df.dtypes)


if __name__ == "__main__":
    import __spark_entry__ as entry

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    folder, keys = sys.argv[1], sys.argv[2:]
    wanted = entry.queries()
    for key in keys or wanted:
        start = time.time()
        sql = entry.oracle_sql().get(key)
        if sql is None:
            print(f"{key}: rows only, {wanted[key](spark, folder).count()}")
            continue
        try:
            rows, problem = compare(spark, folder, wanted[key], sql)
        except Exception as error:  # keep going: this is a report
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        print(f"{'ok ' if not problem else 'BAD'} {key}: {rows} rows, {took:.1f}s {problem}", flush=True)
