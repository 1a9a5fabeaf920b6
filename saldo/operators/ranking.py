"""Largest groups and group filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, key: str, n: int, counted: str | None = None) -> DataFrame:
    """The ``n`` keys with most rows (or most non-null ``counted``); equal counts go by key."""
    groups = df.groupBy(key).agg(F.count(counted or F.lit(1)).alias("n"))
    return groups.orderBy(F.desc("n"), F.asc(key)).limit(n)


def groups_with_average_below(df: DataFrame, key: str, value: str, limit) -> DataFrame:
    """Keys whose average value is under the limit."""
    groups = df.groupBy(key).agg(F.avg(value).alias("average"))
    return groups.filter(F.col("average") < F.lit(limit))
