"""Compare query results with their DuckDB twins, order-insensitive and typed."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from saldo.sources.demo_views import RAW_TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in RAW_TABLES:
        connection.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_key(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str:
    """Empty text when both sides agree on columns, types and rows."""
    theirs = connection.sql(sql)
    ours_types = {n: t for n, t in spark_df.dtypes}
    kind = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE"}
    wanted = {n: kind.get(t, t) for n, t in ours_types.items()}
    got = {n: str(t) for n, t in zip(theirs.columns, theirs.types)}
    if wanted != got:
        wrong = {n: (wanted.get(n), got.get(n)) for n in wanted.keys() | got.keys()
                 if wanted.get(n) != got.get(n)}
        return f"columns differ: {wrong}"
    a = rows_of(spark_df.columns, spark_df.collect())
    b = rows_of(theirs.columns, theirs.fetchall())
    if a == b:
        return ""
    return (f"{sum(a.values())} and {sum(b.values())} rows, only ours {list((a - b).items())[:2]}, "
            f"only theirs {list((b - a).items())[:2]}; columns {sorted(spark_df.columns)}")
