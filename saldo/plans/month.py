"""The run of the tax buffer on stored tables: load, publish, clean up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.functions.dates import Period
from saldo.operators.guards import counted, dimension, rows_seen
from saldo.operators.reload import PERIOD_KEYS, overwrite_partitions, reload_period
from saldo.plans.buffer import (
    BOOK_COLUMNS, DIMENSIONS, GROUPED_COLUMNS, TYPES, UNGROUPED_COLUMNS, TaxBuffer, advance_wraps,
    operations_buffer,
)
from saldo.plans.postings import stored_schema
from saldo.plans.scope import Tables
from saldo.session import scratch_of_run, staged
from saldo.sources.folders import HIVE_NULL, drop_folder, drop_partition, exists, list_partitions

BUFFER, WRAPS, UNGROUPED, GROUPED, BOOK = (
    "operations_buffer", "advance_wrap", "ledger_ungrouped", "ledger_grouped", "book",
)
DATED = ("year_v int", "mnth int")
SCHEMAS = {
    WRAPS: "comp_scala string, invoice string, pay_line int, pay_date date, year_v int, mnth int",
    UNGROUPED: stored_schema(UNGROUPED_COLUMNS, TYPES, *DATED),
    GROUPED: stored_schema(GROUPED_COLUMNS, TYPES, *DATED),
    BOOK: stored_schema(BOOK_COLUMNS, TYPES, *DATED),
}


def _dated(df: DataFrame, day: Column) -> DataFrame:
    return df.withColumns({"year_v": F.year(day), "mnth": F.month(day)})


def stored_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the run with the types it was written with; empty if nothing was written yet."""
    path = f"{out}/{name}"
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def run_buffer(spark: SparkSession, tables: Tables, out: str, period: Period | None = None,
               master: str | None = None, company: str | None = None) -> DataFrame:
    """Run a period (or everything) and return the stored book.

    Every step replaces its own partitions (year, month, company) and reads what the step before
    stored, so a failed or repeated run ends with the same tables. Branches read the ledgers as they
    were loaded; the clean-up comes after the book is published.
    """
    return run_buffer_steps(spark, tables, out, period, master, company)[0]


def run_buffer_steps(spark: SparkSession, tables: Tables, out: str, period: Period | None = None,
                     master: str | None = None, company: str | None = None,
                     ) -> tuple[DataFrame, dict[str, int]]:
    """``run_buffer`` with the number of rows that each step stored, counted while it wrote them. What
    the run staged on the way is deleted at its end."""
    rows: dict[str, int] = {}
    with scratch_of_run(spark):
        for name in (UNGROUPED, GROUPED):
            finish_clean(spark, f"{out}/{name}")
        run = TaxBuffer(tables, period, master, company)
        names = [row[0] for row in run.scope.select("comp_scala").collect()]
        in_scope = F.col("comp_scala").isin(names)

        def reload(name: str, loaded: DataFrame) -> None:
            seen, observation = counted(loaded, name)
            reload_period(seen, f"{out}/{name}", period, names)
            rows[name] = rows_seen(observation)

        for name in DIMENSIONS:
            run.stored[name] = dimension(getattr(run, f"_{name}")(), name)
        buffer = operations_buffer(tables, period).filter(in_scope)
        reload(BUFFER, buffer)
        run.stored["buffer"] = spark.read.schema(buffer.schema).parquet(f"{out}/{BUFFER}").filter(in_scope)
        run.stored["ledger"] = staged(run._ledger(), "ledger")
        reload(WRAPS, _dated(advance_wraps(run.movements), F.col("pay_date")))
        run.stored["wraps"] = run.__dict__["wraps"] = stored_table(spark, out, WRAPS).drop("year_v", "mnth")
        for name in (UNGROUPED, GROUPED):
            ledger = name.removeprefix("ledger_")
            reload(name, _dated(getattr(run, f"_{ledger}")(), F.col("paydate")))
            # the branches below read the stored ledger, not the plan that filled it
            run.stored[ledger] = stored_table(spark, out, name).filter(in_scope)
        reload(BOOK, _dated(run.publish(), F.coalesce("paydate", "inv_date")))
        clean_ledgers(spark, tables, out, period)
    return stored_table(spark, out, BOOK).select(*BOOK_COLUMNS), rows


def clean_ledgers(spark: SparkSession, tables: Tables, out: str,
                  period: Period | None = None) -> None:
    """Take reversed, special, moved and wrapped payments out of the stored ledgers.

    Reversals and special payments are removed from every month, moved and wrapped ones from the
    period. Only partitions that lose a row, found by joining the feeds to the ledger's keys, are
    written again: whole into a folder of their own first, then over the ledger.
    """
    for name in (UNGROUPED, GROUPED):
        path, ledger = f"{out}/{name}", name.removeprefix("ledger_")
        finish_clean(spark, path)
        whole = TaxBuffer(tables, period)
        whole.__dict__[ledger] = rows = stored_table(spark, out, name)  # all months, not only the period
        touched = getattr(whole, f"leaving_{ledger}")().select(*PERIOD_KEYS).distinct()
        # at most one row per partition of the ledger; its values prune the scan
        parts = spark.createDataFrame(touched.collect(), rows.select(*PERIOD_KEYS).schema)
        if parts.isEmpty():
            continue
        parts.coalesce(1).write.mode("overwrite").parquet(f"{path}.touched")
        left = getattr(whole, f"clean_{ledger}")()
        again = left.join(F.broadcast(parts), [left[k].eqNullSafe(parts[k]) for k in PERIOD_KEYS], "left_semi")
        (again.hint("rebalance", *PERIOD_KEYS).write.partitionBy(*PERIOD_KEYS).mode("overwrite")
              .parquet(f"{path}.cleaned"))
        finish_clean(spark, path)


def finish_clean(spark: SparkSession, path: str) -> None:
    """Put the partitions that a clean-up has written in full in place of the ledger's, and drop those
    that lost all rows. Each step may be repeated: if a run ends in between, its folder is still
    there, and the next run or clean-up starts by finishing it."""
    cleaned, touched = f"{path}.cleaned", f"{path}.touched"
    if not exists(spark, f"{cleaned}/_SUCCESS"):
        return
    schema = stored_table(spark, *path.rsplit("/", 1)).schema
    overwrite_partitions(spark.read.schema(schema).parquet(cleaned), path)
    kept = {tuple(values.values()) for values in list_partitions(spark, cleaned, PERIOD_KEYS)}
    for row in spark.read.parquet(touched).collect():
        values = {k: HIVE_NULL if row[k] is None else str(row[k]) for k in PERIOD_KEYS}
        if tuple(values.values()) not in kept:
            drop_partition(spark, path, values)
    drop_folder(spark, cleaned)
