"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Arrow batches are bounded by rows and by bytes, so that long texts do not pile up in a Python task.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound what a Python task holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows set aside from learning: crc32 of the id as text divides evenly. A null id learns."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def total_bytes(df: DataFrame, *columns: str) -> int:
    """Bytes of the given text columns over all rows."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
