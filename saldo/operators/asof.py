"""As-of joins by time buckets: every row gets the latest earlier event of its key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.session import staged


def latest_before(
    rows: DataFrame, events: DataFrame, keys: Sequence[str], time: str, value: str, bucket: Callable[[Column], Column],
) -> DataFrame:
    """``rows`` with the column ``value`` of the latest event of the same keys with a strictly earlier ``time``, NULL if there
    is none. ``events`` holds at most one row per keys and time.

    Events of one key and time bucket become one row: a sorted array, and the value carried in from the buckets before. A
    window carries values over the buckets of a key, never over rows. ``rows`` meet that table in an equi-join
    on keys and bucket, so a key with very many rows is a hot key of a join, which AQE splits, and no key's rows
    meet in one task. The bucket bounds the array: choose it by how often events can come.
    """
    inside = events.filter(F.col(time).isNotNull()).groupBy(*keys, bucket(F.col(time)).alias("_bucket")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(time).alias("at"), F.col(value).alias("value")))).alias("_events")
    )
    asked = rows.filter(F.col(time).isNotNull()).select(*keys, bucket(F.col(time)).alias("_bucket")).distinct()
    both = asked.join(inside, [*keys, "_bucket"], "full")
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.element_at("_events", -1), ignorenulls=True).over(earlier)
    table = staged(both.withColumn("_carried", carried), "buckets")
    here = F.filter("_events", lambda e: e["at"] < F.col(time))
    found = F.coalesce(F.when(F.size(here) > 0, F.element_at(here, -1)), F.col("_carried"))
    joined = rows.withColumn("_bucket", bucket(F.col(time))).join(table, [*keys, "_bucket"], "left")
    return joined.withColumn(value, found["value"]).drop("_bucket", "_events", "_carried")


def latest_within(
    rows: DataFrame, events: DataFrame, keys: Sequence[str], time: str, value: str, slot: Callable[[Column], Column], slots: int,
) -> DataFrame:
    """The same for keys that span a short time, such as one day, which ``slot`` cuts into at most ``slots`` pieces.

    What is staged grows with the events alone: the events of each slot, and for each keys the last event of every slot that has one
    (an array of at most ``slots``). Rows meet both in equi-joins, so again no key's rows meet in one task.
    """
    event = F.struct(F.col(time).alias("at"), F.col(value).alias("value"))
    fine = staged(events.filter(F.col(time).isNotNull()).groupBy(*keys, slot(F.col(time)).alias("_slot")).agg(
        F.array_sort(F.collect_list(event)).alias("_events")
    ), "slots")
    last = F.struct("_slot", F.element_at("_events", -1).alias("last"))
    whole = staged(fine.groupBy(*keys).agg(F.array_sort(F.collect_list(last)).alias("_lasts")).filter(
        F.when(F.size("_lasts") > slots, F.raise_error(F.lit(f"a key spans more than {slots} slots")).cast("boolean")).otherwise(True)
    ), "last-of-slots")
    earlier = F.filter("_lasts", lambda e: e["_slot"] < F.col("_slot"))
    found = rows.withColumn("_slot", slot(F.col(time))).join(whole, list(keys), "left").withColumn(
        "_earlier", F.when(F.size(earlier) > 0, F.element_at(earlier, -1)["last"])
    ).drop("_lasts").join(fine, [*keys, "_slot"], "left")
    here = F.filter("_events", lambda e: e["at"] < F.col(time))
    picked = F.coalesce(F.when(F.size(here) > 0, F.element_at(here, -1)), F.col("_earlier"))
    return found.withColumn(value, picked["value"]).drop("_slot", "_events", "_earlier")
