"""The ledger as a SQL function that returns a table, for people who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from saldo.plans.buffer import Tables, TaxBuffer
from saldo.session import staged

FUNCTION = "ungrouped_ledger"


def register_ledger(spark: SparkSession, tables: Tables) -> str:
    """Create ``ungrouped_ledger(year, month, master)``, a function of the session that returns the ungrouped payment
    ledger of one period and the companies of one master. A NULL month asks for the whole year, a NULL master for
    all companies. The body is SQL over a view, inlined where it is called, so the period reaches the scan of the
    movements and only the columns that are asked for are read."""
    book = TaxBuffer(tables)
    # a function's parameters are not known in subqueries, so each company brings the list of its masters
    masters = book.scope.groupBy("comp_scala").agg(F.collect_set("master").alias("masters"))
    book.ungrouped.join(staged(masters, "masters"), "comp_scala").createOrReplaceTempView("saldo_ungrouped")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in book.ungrouped.schema)
    names = ", ".join(f"l.{c}" for c in book.ungrouped.columns)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {FUNCTION}(y INT, m INT, of_master STRING) RETURNS TABLE({columns})
        RETURN SELECT {names} FROM saldo_ungrouped l
        WHERE l.paydate >= make_date(y, coalesce(m, 1), 1)
          AND l.paydate < add_months(make_date(y, coalesce(m, 1), 1), CASE WHEN m IS NULL THEN 12 ELSE 1 END)
          AND (of_master IS NULL OR array_contains(l.masters, of_master))
    """)
    return FUNCTION
