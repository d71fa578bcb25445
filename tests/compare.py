"""Spark result against SQL result: same columns, same rows, in any order."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from prepline.plans.observations import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimals are not expected in results")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def kind(value) -> str:
    return type(value).__name__


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    found = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if len(found) != len(expected):
        return f"{len(found)} rows instead of {len(expected)}"
    for i, name in enumerate(names):
        a = {kind(r[i]) for r in found if r[i] is not None}
        b = {kind(r[i]) for r in expected if r[i] is not None}
        if a != b:
            return f"{name} holds {a} instead of {b}"
    left = Counter(tuple(plain(v) for v in r) for r in found)
    right = Counter(tuple(plain(v) for v in r) for r in expected)
    if left != right:
        extra, lacking = list((left - right).elements()), list((right - left).elements())
        return f"{len(extra)} rows differ, such as {sorted(map(str, extra))[:3]} instead of {sorted(map(str, lacking))[:3]}"
    return None


def main(folder: str, *names: str) -> None:
    import __spark_entry__ as e
    from prepline.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = e.queries(), e.oracle_sql()
    assert set(oracles) <= set(queries), set(oracles) - set(queries)
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            found = differences(df, con, oracles[name]) if name in oracles else f"rows only: {len(df.collect())}"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None and not found.startswith("rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s  {found or 'equal'}", flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
