"""Price on a date and the price before it: for every product of a list at one moment, or for every row at its own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions.dates import styled
from saldo.operators.asof import latest_before, latest_within

PRODUCT, PRICE, SET_AT, ROW = "kodtov", "cena", "data", "id"
MINUTES_OF_A_DAY = 24 * 60


def _last_of_each_day(prices: DataFrame) -> DataFrame:
    """One row per product and day: the price set last, equal times by id. Aggregated on every task
    first, so a product with very many changes costs one row per task and day."""
    return prices.groupBy(PRODUCT, F.to_date(SET_AT).alias("day")).agg(
        F.max_by(F.struct(PRICE, SET_AT), F.struct(SET_AT, ROW)).alias("last")
    )


def _now_and_before(products: DataFrame, daily: DataFrame) -> DataFrame:
    """Rank days per product (at most one row per calendar day, cut to two on the map side) and put
    the latest and the one before on one row; products without a price stay."""
    newest = Window.partitionBy(PRODUCT).orderBy(F.desc("day"))
    two = daily.withColumn("rk", F.row_number().over(newest)).filter("rk <= 2")
    at = lambda rank: F.max(F.when(F.col("rk") == rank, F.col("last")))
    pair = two.groupBy(PRODUCT).agg(at(1).alias("now"), at(2).alias("before"))
    return products.join(pair, PRODUCT, "left").select(
        PRODUCT,
        F.col(f"now.{PRICE}").alias("price"),
        F.col(f"now.{SET_AT}").alias("price_date"),
        F.col(f"before.{PRICE}").alias("previous_price"),
        F.col(f"before.{SET_AT}").alias("previous_date"),
    )


def _at(moment: datetime):
    return F.lit(moment).cast("timestamp_ntz")


def price_before(products: DataFrame, prices: DataFrame, moment: datetime) -> DataFrame:
    """Price set last strictly before the moment, and the last price of an earlier calendar day."""
    return _now_and_before(products, _last_of_each_day(prices.filter(F.col(SET_AT) < _at(moment))))


def price_effective(products: DataFrame, prices: DataFrame, moment: datetime) -> DataFrame:
    """The last price of a day is valid from the next midnight. The price valid at the moment and
    the one valid before it, with dates as ``dd.MM.yyyy HH:mm:ss`` text."""
    midnight = datetime(moment.year, moment.month, moment.day)
    daily = _last_of_each_day(prices.filter(F.col(SET_AT) < _at(midnight)))
    text = lambda c: F.concat(styled(F.col(c), 104), F.lit(" "), styled(F.col(c), 108))
    return _now_and_before(products, daily).withColumns(
        {"price_date": text("price_date"), "previous_date": text("previous_date")}
    )


def _price_columns(rows: DataFrame, now: str, before: str) -> DataFrame:
    return rows.withColumns({
        "price": F.col(f"{now}.{PRICE}"), "price_date": F.col(f"{now}.{SET_AT}"),
        "previous_price": F.col(f"{before}.{PRICE}"), "previous_date": F.col(f"{before}.{SET_AT}"),
    }).drop(now, before)


def _by_day(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """``rows`` with ``_pair``: the last price of the latest day before ``day`` that has one (``now``), and of the day with a price
    before that (``before``). Windows see one row per product and calendar day, or month."""
    daily = _last_of_each_day(prices)
    by_day = Window.partitionBy(PRODUCT).orderBy("day")
    pairs = daily.withColumn("_pair", F.struct(F.col("last").alias("now"), F.lag("last").over(by_day).alias("before")))
    return latest_before(rows, pairs.drop("last"), [PRODUCT], "day", "_pair", lambda day: F.trunc(day, "month"))


def prices_effective(rows: DataFrame, prices: DataFrame, at: str) -> DataFrame:
    """Every row with the price valid at its own moment ``at`` (a date or a time) and the one valid before, when the last price
    of a day is valid from the next midnight. Rows without a product or moment, or without a price, get NULLs."""
    found = _by_day(rows.withColumn("day", F.to_date(at)), prices).drop("day")
    return _price_columns(found.withColumns({"_now": F.col("_pair.now"), "_before": F.col("_pair.before")}), "_now", "_before").drop("_pair")


def prices_before(rows: DataFrame, prices: DataFrame, at: str) -> DataFrame:
    """Every row with the price set last strictly before its own moment ``at``, and the last price of an earlier calendar day.

    A price of the moment's own day is looked up among that day's changes, in slots of a minute; otherwise the last
    price of an earlier day counts."""
    changes = prices.groupBy(PRODUCT, SET_AT).agg(F.max_by(PRICE, ROW).alias(PRICE)).select(
        PRODUCT, F.to_date(SET_AT).alias("day"), F.col(SET_AT).alias("_at"), F.struct(PRICE, SET_AT).alias("_own")
    )
    moments = rows.withColumns({"day": F.to_date(at), "_at": F.col(at).cast("timestamp_ntz")})
    minute = lambda time: F.hour(time) * 60 + F.minute(time)
    own = latest_within(moments, changes, [PRODUCT, "day"], "_at", "_own", minute, MINUTES_OF_A_DAY)
    found = _by_day(own, prices).drop("day", "_at").withColumns({
        "_now": F.coalesce("_own", "_pair.now"),
        "_before": F.when(F.col("_own").isNotNull(), F.col("_pair.now")).otherwise(F.col("_pair.before")),
    })
    return _price_columns(found, "_now", "_before").drop("_pair", "_own")
