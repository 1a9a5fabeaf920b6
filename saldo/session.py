"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from saldo.sources.folders import drop_folder

# Scratch folder of the run in progress, if it has its own.
_RUN: ContextVar[str | None] = ContextVar("scratch folder of the run", default=None)

# Runtime-settable SQL options the jobs count on. Joins carry no broadcast hints for tables that can
# grow: the planner (estimated size) and AQE (measured size) broadcast only what is below the limit,
# and skewed shuffle partitions are split, also where that costs an extra shuffle.
SQL_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Fixed when the session starts: call-site capture costs several round trips to the JVM per column
# expression while a plan is built.
START_OPTIONS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL options above to a running session."""
    for key, value in SQL_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "saldo", master: str | None = None, **options: str) -> SparkSession:
    """A session for tests, the bench and small jobs; clusters bring their own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_OPTIONS, **START_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local master, where all tasks share one disk, may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="saldo-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, or of the current run's folder in it."""
    return f"{_RUN.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_of_run(spark: SparkSession):
    """What is staged inside goes to a folder of its own, which is deleted when the run ends well. For
    runs that store their result elsewhere; after a failure the folder stays."""
    folder = scratch_path(spark, "run")
    before = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(before)
    drop_folder(spark, folder)


def cut_lineage(df):
    """Reliable checkpoint: survives the loss of executors, and later reads start from files."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def staged(df, name: str, **options: str):
    """Write an intermediate table to the shared folder and read it back. What follows starts from
    files: it survives lost executors, reads only the columns it needs, and the planner knows the
    real size, so a small table is broadcast and a large one is not. `options` go to the writer.

    Aggregated tables are staged before they are joined on their own key. Joined directly, the
    aggregate would lend the join its partitioning, and AQE splits a hot partition of the other side
    only when both sides are shuffled for the join."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
