"""Duplicate removal: newest per key, exact copies, and tables too large for one pass."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saldo.session import scratch_path, staged
from saldo.sources.folders import drop_folder, exists, replace_folder

SLICE = "slice"


def _newest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order]


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the newest by ``order``, whose last column must settle ties.

    The filter on the row number lets Spark cut every key to one row on the map side
    (``WindowGroupLimit``), so a key with very many rows reaches its reducer as one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(order))
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def superseded(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows for which a newer row of the same key exists."""
    return _against_newest(df, keys, order, newest=False)


def drop_superseded(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What is left after deleting superseded rows.

    Pairwise form without pairs: the newest order value per key is aggregated first, then matched
    on key and order together, so no join key is as large as the group.
    """
    return _against_newest(df, keys, order, newest=True)


def _against_newest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    newest: bool) -> DataFrame:
    last = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last"))
    last = last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in order])
    same = [df[c].eqNullSafe(last[c]) for c in (*keys, *order)]
    return df.join(last, same, "left_semi" if newest else "left_anti")


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Every different row once, with the number of copies; ``copies > 1`` are the duplicates."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def _slice_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def lay_in_slices(df: DataFrame, path: str, keys: Sequence[str], n: int) -> None:
    """Write a table partitioned by the hash of its key. A slice that holds a hot key is split over
    several files by the rebalance step."""
    sliced = df.withColumn(SLICE, _slice_of(keys, n))
    sliced.hint("rebalance", SLICE).write.partitionBy(SLICE).mode("overwrite").parquet(path)


def dedup_in_slices(spark: SparkSession, src: str, dst: str, keys: Sequence[str],
                    order: Sequence[str], n: int, at_once: int = 4) -> DataFrame:
    """Newest row per key of a table laid out by ``lay_in_slices``, ``at_once`` slices at a time.

    Equal keys share a slice, so each pass reads one partition of the source and holds only that
    much shuffle data; ``at_once`` passes fill the cluster where one slice would not. A pass overwrites exactly its own output slice: after a failure the run is
    simply started again, and slices that are already written are skipped.
    """
    schema = spark.read.parquet(src).schema

    def clean(i: int) -> None:
        target = f"{dst}/{SLICE}={i}"
        if not exists(spark, f"{target}/_SUCCESS"):
            part = spark.read.schema(schema).parquet(src).filter(F.col(SLICE) == i).drop(SLICE)
            keep_latest(part, keys, order).write.mode("overwrite").parquet(target)

    with ThreadPoolExecutor(at_once) as passes:
        list(passes.map(inheritable_thread_target(spark)(clean), range(n)))
    return spark.read.option("basePath", dst).schema(schema).parquet(dst)


def _cell(keys: Sequence[str], cells: int) -> Column:
    """Hash cell of a key, independent of its slice."""
    return F.pmod(F.xxhash64(F.lit("cell"), *keys), F.lit(cells)) + 1  # bitmaps count from 1


def key_sketch(keys: DataFrame, cells: int) -> DataFrame:
    """(bucket, cells): which of ``cells`` hash cells hold more than one row, as bitmaps of 32,768 cells.

    Both steps are mergeable aggregates, combined on every task: rows per cell, then a bitmap per bucket. A key with a
    second row always has its bit; a key without one shares a cell by chance in about rows / cells of cases. The
    result is at most ``cells / 8`` bytes, in whole bitmaps of 4 KB, whatever the table holds."""
    count = keys.groupBy(_cell(keys.columns, cells).alias("cell")).agg(F.count("*").alias("n"))
    return count.filter("n > 1").groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )


def with_second_rows(df: DataFrame, keys: Sequence[str], sketch: DataFrame, cells: int) -> DataFrame:
    """``df`` with ``_second``: whether the sketch has its key. The sketch is broadcast; its size is bounded by ``cells``."""
    cell = _cell(keys, cells)
    place = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    bit = F.getbit(byte, (place % 8).cast("int"))
    bucket = F.bitmap_bucket_number(cell)
    joined = df.withColumn("_bucket", bucket).join(F.broadcast(sketch.withColumnRenamed("bucket", "_bucket")), "_bucket", "left")
    return joined.withColumn("_second", F.coalesce(bit == 1, F.lit(False))).drop("_bucket", "bits")


def dedup_in_place(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], n: int,
                   at_once: int = 1, most_cells: int = 1 << 27) -> DataFrame:
    """Newest row per key of a table laid out by ``lay_in_slices``, cleaned where it lies.

    A slice is read for its keys first. Their sketch tells which rows may have a second one: only those are shuffled, the
    others are copied as they are read. The new slice is written beside the table and then takes the old one's
    place, so besides the table there are at most ``at_once`` of ``n`` slices, the shuffled keys of as many, and their doubtful
    rows. A slice that no row leaves is not written at all. A sketch has 16 cells a row, ``most_cells`` (16 MB) at most;
    slices beyond some 10 million rows find more rows doubtful, and are cleaned as well.

    A new slice counts once its ``_SUCCESS`` is there: a run that ends before starts the slice again, one that ends
    between dropping and moving is finished by the next, so no row is lost. Readers of a slice that is being replaced
    have to come back.
    """
    schema = spark.read.parquet(path).schema
    rows = StructType([field for field in schema if field.name != SLICE])
    fresh = f"{path}.cleaned"

    def clean(i: int) -> None:
        old, new = f"{path}/{SLICE}={i}", f"{fresh}/{SLICE}={i}"
        if not exists(spark, f"{new}/_SUCCESS"):
            if not exists(spark, old):
                return
            part = spark.read.schema(rows).parquet(old)
            cells = min(most_cells, max(1, 16 * part.count()))
            sketch = staged(key_sketch(part.select(*keys), cells), "key-sketch")
            if sketch.isEmpty():
                return
            marked = with_second_rows(part, keys, sketch, cells)
            single = marked.filter("not _second").drop("_second")
            several = keep_latest(marked.filter("_second").drop("_second"), keys, order)
            single.unionByName(several).write.mode("overwrite").parquet(new)
        replace_folder(spark, new, old)

    with ThreadPoolExecutor(at_once) as passes:
        list(passes.map(inheritable_thread_target(spark)(clean), range(n)))
    drop_folder(spark, fresh)
    return spark.read.schema(schema).parquet(path)


def bulk_dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Lay a DataFrame out in slices in the shared folder and clean it slice by slice."""
    spark = df.sparkSession
    src, dst = scratch_path(spark, "sliced"), scratch_path(spark, "unique")
    lay_in_slices(df, src, keys, n)
    return dedup_in_slices(spark, src, dst, keys, order, n).drop(SLICE)
