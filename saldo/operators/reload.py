"""Replacing and deleting rows of stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.dates import Period, in_period
from saldo.sources.folders import drop_partition, partition_files

PERIOD_KEYS = ("year_v", "mnth", "comp_scala")


def overwrite_partitions(df: DataFrame, path: str) -> None:
    """Replace the partitions that ``df`` has rows for when the job commits. The rebalance step makes
    files of even size: small partitions go to one task each, a partition with a large share of the
    rows is split over many."""
    (df.hint("rebalance", *PERIOD_KEYS).write.partitionBy(*PERIOD_KEYS).mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").parquet(path))


def reload_period(df: DataFrame, path: str, period: Period | None = None,
                  companies: Sequence[str] | None = None) -> None:
    """Replace the rows of a period (or of all), of all companies or of those named; a second run
    with the same rows changes nothing.

    Partitions of the period and scope that have no rows any more, seen by their files not having
    been replaced, are dropped after the write.
    """
    spark = df.sparkSession
    reach = dict.fromkeys(PERIOD_KEYS, "*")
    if period is not None:
        reach |= {"year_v": str(period.year), "mnth": str(period.month or "*")}
    before = partition_files(spark, path, reach)
    overwrite_partitions(df, path)
    after = partition_files(spark, path, reach)
    for key, files in before.items():
        values = dict(zip(PERIOD_KEYS, key, strict=True))
        if (companies is None or values["comp_scala"] in companies) and files == after.get(key):
            drop_partition(spark, path, values)


def delete_period(df: DataFrame, period: Period, *days: str) -> DataFrame:
    """Rows none of whose dates lie in the period; NULL dates lie in no period."""
    return delete_where(df, _any([in_period(period, F.col(d)) for d in days]))


def delete_where(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which the rule is not true (false or unknown, as a DELETE leaves them)."""
    return df.filter(~F.coalesce(rule, F.lit(False)))


def delete_matching(df: DataFrame, others: DataFrame, on: Column | list[Column]) -> DataFrame:
    """Rows without a partner in the other table."""
    return df.join(others, on, "left_anti")


def append_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Line a DataFrame up with the column list of its target; a missing column is an error."""
    return df.select(*columns)


def _any(rules: list[Column]) -> Column:
    met = F.coalesce(rules[0], F.lit(False))
    for rule in rules[1:]:
        met = met | F.coalesce(rule, F.lit(False))
    return met
