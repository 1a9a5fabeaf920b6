"""Streaming front door of the activity history."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from saldo.plans.snapshots import store_batch


def read_stream(spark: SparkSession, folder: str, schema: StructType,
                pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def stream_snapshots(stream: DataFrame, path: str, checkpoint: str,
                     open_days: Callable[[], Sequence[date]], source: str = "") -> StreamingQuery:
    """Route arriving history rows to their day and append them; late rows whose day is closed go to
    the default partition, as in the batch job, which may write to the same path.

    A micro-batch is stored under its number and replaced when it is replayed after a failure, so a row is
    stored once. Several streams into one history need different ``source`` names, as each counts from 0.
    """
    def store(rows: DataFrame, batch: int) -> None:
        store_batch(rows, open_days(), path, f"{source}-{batch}" if source else str(batch))

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
