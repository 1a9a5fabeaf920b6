"""Dense ascending ids for new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.session import cut_lineage

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def assign_ids(existing: DataFrame, new: DataFrame, order: Sequence[str],
               id_column: str = "id") -> DataFrame:
    """``new`` with ids that go on after the largest existing one, in ``order`` (a total order).

    Rows are range-partitioned and sorted, never brought into one task. The partitions are fixed by
    a reliable checkpoint before they are counted; only one count per partition comes to the driver.
    """
    ordered = new.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = cut_lineage(ordered).withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", ROW_BITS)
    sizes = fixed.groupBy(part.alias("part")).count().orderBy("part").collect()
    start = existing.agg(F.max(id_column)).first()[0] or 0
    starts, total = [], start
    for row in sizes:
        starts.append((row["part"], total))
        total += row["count"]
    offsets = new.sparkSession.createDataFrame(starts, "part long, start long")
    row_in_part = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = fixed.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbered.withColumn(id_column, F.col("start") + row_in_part + 1).drop(
        "part", "start", "_at"
    )
