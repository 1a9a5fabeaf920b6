"""A dimension that takes far more memory than its rows need on disk is not broadcast."""

from __future__ import annotations

from collections import ChainMap

import pytest
from pyspark.sql import functions as F

from saldo.operators.guards import dimension
from saldo.plans.buffer import TaxBuffer

LIMIT = 1 << 20


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def estimate(df) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@pytest.fixture()
def limit(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(LIMIT))
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def accounts(spark, count: int):
    """Accounts repeated over seven years and two sets, as the chart holds them."""
    flag = F.col("id") % 2
    return (
        spark.range(count).repartition(1)
        .withColumn("id_example", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("year_v", F.explode(F.sequence(F.lit(1992), F.lit(1998))))
        .select(F.concat(F.lit("1"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("account_b"),
                F.concat(F.lit("Account number "), F.col("id")).alias("account_name"),
                F.lit(2).alias("vat_code"), *[flag.cast("int").alias(c) for c in (
                    "tax_acr", "tax_rd", "tax_pay", "tax_rep", "advance", "auto_system", "purch_book")],
                F.lit("1").alias("currency_id"), "year_v", "id_example")
    )


def test_the_planner_sees_what_a_dimension_takes_in_memory(spark, limit):
    rows = accounts(spark, 4000)
    got = dimension(rows)
    assert got.count() == 4000 * 14 and got.exceptAll(rows).isEmpty()
    # over 8 bytes a column in memory; written compressed, the files had under a byte
    assert estimate(got) > 4000 * 14 * 8 * len(rows.columns) / 2 > LIMIT
    facts = spark.range(1 << 20).select(F.col("id").cast("string").alias("account_b"), F.lit(1994).alias("year_v"))
    joined = facts.join(got, ["account_b", "year_v"])
    assert "BroadcastHashJoin" not in physical(joined)
    small = facts.join(dimension(rows.limit(20)), ["account_b", "year_v"])
    assert "BroadcastHashJoin" in physical(small)


def test_a_run_does_not_broadcast_a_large_chart(spark, tables, limit):
    run = TaxBuffer(ChainMap({"plan_schetov": accounts(spark, 4000)}, tables))
    others = ("customers", "buffer", "ledger", "wraps", "ungrouped", "grouped")
    run.stored = dict.fromkeys(others, spark.range(1))
    run.stage()
    assert run.plan.count() == 4000 * 14
    assert estimate(run.plan) > LIMIT
    facts = spark.range(1 << 20).select(
        F.col("id").cast("string").alias("acc"), F.lit("31").alias("master"), F.lit(1994).alias("year_v")
    )
    assert "BroadcastHashJoin" not in physical(facts.join(run.plan, ["master", "year_v", "acc"]))


def test_sets_look_smaller_than_the_accounts_they_pick(spark, tables, limit):
    """Else the write-off accounts, some millions of a large chart, are broadcast to the sets of five companies."""
    run = TaxBuffer(ChainMap({"plan_schetov": accounts(spark, 40)}, tables))
    assert estimate(run.sets) < 64 << 10
    assert run.sets.count() == tables["company_main"].count() > 0
