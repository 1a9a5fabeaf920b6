"""Keyed lookup with a rule for keys that match nothing and keys that match several rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.session import staged


def lookup(keys: DataFrame, dim: DataFrame, on: str, value: str, *, on_empty: str = "keep",
           default: str | None = None, on_many: str = "last",
           order: Sequence[str] = ()) -> DataFrame:
    """``keys`` with the value of ``dim`` for each key.

    ``on_empty``: ``keep`` gives the default, ``null`` gives NULL. ``on_many``: ``last`` takes the
    last row by ``order``; ``error`` fails the job as soon as a looked-up key has two rows. A key
    whose only value is NULL gives NULL under both rules.
    """
    if on_empty not in ("keep", "null") or on_many not in ("last", "error"):
        raise ValueError("on_empty is keep or null, on_many is last or error")
    if on_many == "last" and not order:
        raise ValueError("the last row needs an order")
    picked = (F.max_by(F.struct(value), F.struct(*order)) if on_many == "last"
              else F.first(F.struct(value)))
    found = dim.groupBy(on).agg(picked.alias("_picked"), F.count(F.lit(1)).alias("_rows"))
    joined = keys.join(staged(found, "lookup"), on, "left")
    result = F.col(f"_picked.{value}")
    if on_empty == "keep":
        result = F.when(F.col("_rows").isNull(), F.lit(default)).otherwise(result)
    if on_many == "error":
        message = F.concat(F.lit("several rows for key "), F.col(on).cast("string"))
        result = F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(result)
    return joined.withColumn(value, result).drop("_picked", "_rows")
