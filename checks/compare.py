"""Run queries against their SQL in DuckDB: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLES
from checks.queries import QUERIES
from vintagelens.session import build_session

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def sql_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())


def difference(spark, connection, name: str, sf_dir: str) -> tuple[str, int]:
    """Empty text if the query and its SQL agree in columns and rows, and the row count."""
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    total = sum(rows.values())
    if name not in ORACLES:
        return ("" if total else "no rows"), total
    sql_names, expected = sql_rows(connection, ORACLES[name])
    if names != sql_names:
        return f"columns {set(names) ^ set(sql_names)}", total
    if rows != expected:
        ours, theirs = list((rows - expected).items()), list((expected - rows).items())
        return f"{len(ours)} / {len(theirs)} rows differ, such as\n   {ours[:1]}\n   {theirs[:1]}", total
    return ("" if total else "no rows"), total


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dict):
        return tuple(sorted(value.items()))
    if isinstance(value, list):
        return tuple(value)
    return value


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    wrong = 0
    for name in names:
        started = time.time()
        try:
            found, total = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report every query, then fail
            found, total = f"{type(error).__name__}: {str(error)[:600]}", 0
        wrong += bool(found)
        check = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {check} {name:32} {total:7} rows {time.time() - started:6.1f}s {found}", flush=True)
    print(f"{len(names) - wrong} of {len(names)} agree")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main())
