"""Process activity: views over collected rows, the day-partitioned history, retention."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.sources.folders import drop_partition, list_partitions

DEFAULT_DAY = "__default__"
SESSION = ["datname", "usename", "application_name", "state_q", "query"]
METRICS = ["res_mb", "virt_mb", "swap_mb", "command", "state", "utime", "stime", "pcpu", "read_bytes",
           "write_bytes", "voluntary_ctxt_switches", "nonvoluntary_ctxt_switches", "threads"]
VIEW_COLUMNS = ["pid", *SESSION, *METRICS]
HISTORY_COLUMNS = ["ts", *VIEW_COLUMNS]


def _sessions(sessions: DataFrame) -> DataFrame:
    return sessions.withColumnRenamed("state", "state_q").select("pid", *SESSION)


def all_processes(metrics: DataFrame) -> DataFrame:
    """Every metric row under the names of the reports."""
    return metrics.withColumns(
        {"pcpu": F.col("cpu_usage"), "state": F.col("state").cast("string")}
    ).select("pid", *METRICS)


def session_metrics(sessions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every session that has a process id, with the metrics of the process when there are any. The
    id shown is the metric row's: NULL when it is missing."""
    known = _sessions(sessions).filter("pid is not null")
    found = all_processes(metrics).withColumn("asked", F.col("pid"))
    return known.withColumnRenamed("pid", "asked").join(found, "asked", "left").select(*VIEW_COLUMNS)


def process_sessions(sessions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every process, with its session if it has one."""
    return _sessions(sessions).join(all_processes(metrics), "pid", "right").select(*VIEW_COLUMNS)


def day_partition(ts: Column, open_days: Sequence[date]) -> Column:
    """Partition of a row: its day if that day is open, else the default partition."""
    day = F.to_date(ts)
    text = F.date_format(day, "yyyy-MM-dd")
    is_open = day.isin(list(open_days)) if open_days else F.lit(False)
    return F.coalesce(F.when(is_open, text), F.lit(DEFAULT_DAY))


def route(history: DataFrame, open_days: Sequence[date]) -> DataFrame:
    return history.withColumn("day", day_partition(F.col("ts"), open_days))


def open_days_at(as_of: date) -> list[date]:
    """The days the daily maintenance keeps open: the current one and the next."""
    return [as_of, as_of + timedelta(days=1)]


def store_batch(rows: DataFrame, open_days: Sequence[date], path: str, batch: str) -> None:
    """Write one batch of history rows: the only layout of a history, ``day=/batch=``, for jobs and streams.

    What the batch has stored before is dropped first, on whatever days, so it can be repeated after a
    failure, also when other days are open by then, and a row is stored once."""
    for held in list_partitions(rows.sparkSession, path, ["day", "batch"]):
        if held["batch"] == batch:
            drop_partition(rows.sparkSession, path, held)
    routed = route(rows.select(*HISTORY_COLUMNS), open_days).withColumn("batch", F.lit(batch))
    routed.hint("rebalance", "day").write.partitionBy("day", "batch").mode("append").parquet(path)


def append_snapshot(view: DataFrame, ts: datetime | None, open_days: Sequence[date],
                    path: str, batch: str | None = None) -> None:
    """Stamp a view with the time of the snapshot and append it to the history. Rows that carry
    their own ``ts`` (a replay) are appended with ``ts=None``.

    ``batch`` names the append; the same name again replaces it. A stamped snapshot is named by its
    time, an unnamed replay is new every time. Names are letters, digits, ``-`` and ``_``, and no bare number: those
    are the stream's."""
    if ts is not None:
        view = view.withColumn("ts", F.lit(ts).cast("timestamp_ntz"))
    if batch is None:
        batch = f"at-{ts:%Y%m%dT%H%M%S%f}" if ts is not None else f"replay-{uuid.uuid4().hex}"
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch) or batch.isdigit():
        raise ValueError(f"not a batch name: {batch}")
    store_batch(view, open_days, path, batch)


def read_history(spark: SparkSession, path: str, schema) -> DataFrame:
    """The history with ``day`` as text, so that the default partition keeps its name. Batches are no column of it."""
    return spark.read.schema(schema).parquet(path).drop("batch")


def expired_days(days: Sequence[str], as_of: date, keep: int) -> list[str]:
    """Days strictly older than ``as_of`` minus ``keep``; names that are no day are left alone."""
    expired = []
    for name in days:
        try:
            day = datetime.strptime(name, "%Y-%m-%d").date()
        except ValueError:
            continue
        if day < as_of - timedelta(days=keep):
            expired.append(name)
    return expired


def retain(spark: SparkSession, path: str, as_of: date, days: int = 3) -> list[str]:
    """Drop expired day partitions and return their names. Only folder names are read, and a second
    run finds nothing to drop."""
    names = [values["day"] for values in list_partitions(spark, path, ["day"])]
    expired = expired_days(names, as_of, days)
    for name in expired:
        drop_partition(spark, path, {"day": name})
    return expired
