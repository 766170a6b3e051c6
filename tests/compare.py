"""Row-by-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_cell(row[n]) for n in names) for row in df.collect())


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, Counter(tuple(_cell(row[i]) for i in order) for row in result.fetchall())


def difference(df, connection, sql) -> str | None:
    names, mine = spark_rows(df)
    other_names, theirs = duck_rows(connection, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if mine == theirs:
        return None
    return (f"{sum(mine.values())} rows, {sum(theirs.values())} expected; "
            f"only here {list((mine - theirs).items())[:3]}; missing {list((theirs - mine).items())[:3]}")
