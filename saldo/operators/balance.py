"""Running balances and signed statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions.money import money


def daily_balance(income: DataFrame, outcome: DataFrame, key: str, day: str,
                  amount: str) -> DataFrame:
    """Money left per key at the end of every day on which the key had a movement.

    Movements are summed per key and day before the window, so a window partition holds at most
    one row per calendar day however many movements a key has.
    """
    signed = income.select(key, F.to_date(day).alias("day"), F.col(amount).alias("moved")).unionByName(
        outcome.select(key, F.to_date(day).alias("day"), (-F.col(amount)).alias("moved"))
    )
    daily = signed.groupBy(key, "day").agg(F.sum("moved").alias("moved"))
    upto = Window.partitionBy(key).orderBy("day")
    return daily.select(key, "day", money(F.sum("moved").over(upto)).alias("balance"))


def signed_stats(df: DataFrame, amount: str) -> DataFrame:
    """Smallest, largest and total amount, totals by sign, and the number of different amounts.

    Amounts are first reduced to one row per different value (partial aggregation on every task),
    so the last step adds up values and not movements.
    """
    value = F.col(amount)
    values = df.groupBy(amount).agg(F.count(amount).alias("times"))
    weight = F.col("times").cast("decimal(19,0)")
    total = lambda rule: F.sum(F.when(rule, value * weight).otherwise(0))
    return values.agg(
        F.min(value).alias("min_amount"),
        F.max(value).alias("max_amount"),
        F.sum(value * weight).alias("sum_amount"),
        total(value > 0).alias("sum_positive"),
        total(value < 0).alias("sum_negative"),
        F.count(value).alias("distinct_amounts"),
    )
