"""Plans and skew: what must hold when one key has a third of the rows."""

from __future__ import annotations

import re
from collections import ChainMap

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from saldo.catalogue import MONTH
from saldo.operators import balance, chains, dedup, pricing
from saldo.plans.book import SalesBook
from saldo.plans.buffer import TaxBuffer
from saldo.plans.sql import register_ledger
from saldo.session import SQL_OPTIONS, shared_folder
from conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = ["day_balance", "latest_per_key", "superseded_pairs", "exact_duplicates", "price_before_day",
        "price_next_day_effective", "price_of_lines_effective", "price_of_lines_before", "lookup_policies", "chain_change_date", "book_all", "book_month",
        "ops_buffer", "advance_wrap", "ungrouped_ledger", "grouped_ledger", "buf_payments",
        "buf_reversals", "buf_payments_grouped", "session_metrics", "process_sessions"]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_single_task_window(spark, name):
    text = physical(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Window .*\n\s*\+- .*Sort.*\n\s*\+- .*Exchange SinglePartition", text)
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_period_and_company_reach_the_scan(tables):
    text = physical(SalesBook(tables, MONTH, "02").accruals())
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    assert "l_discount" not in scan.split("ReadSchema")[1]


def test_period_of_the_sql_function_reaches_the_scan(spark, tables):
    name = register_ledger(spark, tables)
    text = physical(spark.sql(f"select comp_scala, sum(amount_loc) as total from {name}(1996, 12, '31') group by 1"))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    assert "l_discount" not in scan.split("ReadSchema")[1] and "PythonUDF" not in text
    ledger = TaxBuffer(tables).ungrouped
    year = spark.sql(f"select * from {name}(1996, null, null)")
    assert year.count() == ledger.where("year(paydate) = 1996").count() > 0
    assert year.columns == ledger.columns


def test_direct_branches_scan_the_ledger_once(tables):
    text = physical(SalesBook(tables).direct())
    # the write-off list, which the demo tables take from the same file, is staged before
    assert text.count("lineitem.parquet") == 1


def test_whole_book_meets_accounts_once(tables):
    """Movements and card lines are read from what was staged with their accounts; only the write-off list and its
    map are read again. Customers, the widest, come after invoices and flags."""
    text = physical(SalesBook(tables).whole())
    assert "l_extendedprice" not in text and "tax_rep" not in text
    direct = physical(SalesBook(tables).direct())
    joins = [x for x in direct.splitlines() if "Join" in x and "LeftOuter" in x]
    assert ["org_code" in x for x in joins] == [True, False, False]  # the topmost join is the last one


def test_repeated_invoices_book_their_lines_once_each(tables):
    twice = ChainMap({"invoices": tables["invoices"].unionByName(tables["invoices"])}, tables)
    for branch in ("shipment", "activation"):
        once = getattr(SalesBook(tables), branch)().agg(F.sum("fact_amt")).first()[0]
        assert getattr(SalesBook(twice), branch)().agg(F.sum("fact_amt")).first()[0] == 2 * once != 0


def test_reversed_payments_are_an_anti_join(tables):
    assert "LeftAnti" in physical(TaxBuffer(tables).payments())


def test_newest_row_is_cut_on_the_map_side(tables):
    text = physical(dedup.keep_latest(tables["events"], ["user_id"], ["ts", "event_id"]))
    assert text.count("WindowGroupLimit") == 2


def test_books_agree_without_any_broadcast(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = SalesBook(tables, MONTH).whole()
        assert "BroadcastHashJoin" not in physical(shuffled)
        a = sorted(map(str, shuffled.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert a == sorted(map(str, SalesBook(tables, MONTH).whole().collect()))


def skewed(spark, n=30000):
    """A third of the rows has key 0."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("v")
    )


def test_hot_key_reaches_the_reducer_cut_down(spark):
    df = skewed(spark).repartition(8)
    latest = dedup.keep_latest(df, ["k"], ["v"])
    assert {r["k"]: r["v"] for r in latest.collect()} == {
        r["k"]: r["v"] for r in df.groupBy("k").agg(F.max("v").alias("v")).collect()}


def test_hot_product_prices(spark):
    prices = skewed(spark).select(
        F.col("k").cast("string").alias("kodtov"), F.col("v").cast("decimal(10,2)").alias("cena"),
        F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, v * 60)").alias("data"),
        F.col("v").alias("id"))
    products = prices.select("kodtov").distinct()
    from datetime import datetime
    at = datetime(2020, 1, 15, 12, 0)
    got = {r[0]: (r[1], r[3]) for r in pricing.price_before(products, prices, at).collect()}
    by_product: dict[str, list] = {}
    for r in prices.filter(F.col("data") < F.lit(at).cast("timestamp_ntz")).collect():
        by_product.setdefault(r["kodtov"], []).append((r["data"], r["id"], r["cena"]))
    for product, (now, before) in got.items():
        rows = sorted(by_product.get(product, []))
        want = rows[-1] if rows else None
        older = [r for r in rows if want and r[0].date() < want[0].date()]
        assert now == (want[2] if want else None)
        assert before == (older[-1][2] if older else None)


def test_hot_last_card(spark):
    n = 5000
    edges = spark.range(1, n).select(
        F.col("id").alias("old_card"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") + 1 + F.col("id") % 2).alias("new_card"),
        F.lit("2020-01-01").cast("date").alias("dt"))
    follow = {r["old_card"]: r["new_card"] for r in edges.collect()}
    lengths = {}
    for card in follow:
        at, length = card, 0
        while at in follow:
            at, length = follow[at], length + 1
        lengths[card] = (length, at)
    got = {r["card"]: (r["length"], r["last_card"]) for r in chains.chain_closure(edges).collect()}
    assert got == lengths
    held = {r["card"] for r in chains.chain_of(edges, 3).collect()}
    assert held == {c for c, (length, _) in lengths.items() if length >= 3}


def test_window_sees_days_not_movements(spark):
    df = skewed(spark).withColumn("d", F.expr("date_add(date'2020-01-01', cast(v % 20 as int))"))
    df = df.withColumn("v", F.col("v").cast("decimal(19,4)"))
    result = balance.daily_balance(df, df.limit(0), "k", "d", "v")
    text = physical(result)
    assert text.index("Window") < text.index("HashAggregate")
    total = result.filter("k = 0 and day = date'2020-01-20'").first()["balance"]
    assert total == df.filter("k = 0").agg(F.sum("v")).first()[0]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert SQL_OPTIONS["spark.sql.adaptive.skewJoin.enabled"] == "true"


@pytest.fixture
def skew_visible(spark):
    """Thresholds so low that the test data counts as skewed."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in low.items():
        spark.conf.set(key, value)
    yield
    for key in low:
        spark.conf.unset(key)


def final_plan(df) -> str:
    df.collect()
    return physical(df)


def test_hot_key_of_a_lookup_is_split(spark, skew_visible):
    from saldo.operators import lookup
    keys = skewed(spark).repartition(8)
    dim = spark.range(997).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    found = lookup.lookup(keys, dim, "k", "name", order=["name"])
    assert "skew=true" in final_plan(found)
    assert found.count() == 30000 and found.filter("name is null").count() == 0


def test_hot_product_of_lines_is_split(spark, skew_visible):
    lines = spark.range(30000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 997).cast("string").alias("kodtov"),
        F.to_date(F.lit("2024-01-20")).alias("at"), F.col("id").alias("line"))
    prices = spark.range(997).select(
        F.col("id").cast("string").alias("kodtov"), F.col("id").cast("decimal(10,2)").alias("cena"),
        F.expr("timestamp_ntz'2024-01-02 00:00:00'").alias("data"), "id")
    found = pricing.prices_effective(lines, prices, "at")
    assert "skew=true" in final_plan(found)
    assert found.count() == 30000 and found.filter("price is null").count() == 0


def test_hot_next_card_is_split(spark, skew_visible):
    edges = spark.range(1, 30000).repartition(8).select(
        F.col("id").alias("old_card"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") + 1 + F.col("id") % 2).alias("new_card"),
        F.lit("2020-01-01").cast("date").alias("dt"))
    assert "skew=true" in final_plan(chains.chain_of(edges, 2))


def test_hot_parent_is_split(spark, skew_visible):
    from saldo.plans import scope
    people = spark.range(30000).repartition(8).select(
        F.lit(31).alias("id_example"), F.col("id").alias("organization_id"),
        F.col("id").cast("string").alias("org_code"), F.lit("n").alias("org_name"),
        F.lit(None).cast("string").alias("inn"), F.lit(None).cast("string").alias("kpp"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("report_org_id"))
    joined = scope.customers({"organizations": people})
    assert "skew=true" in final_plan(joined)
    assert joined.filter("parent_code = '7'").count() == 10001


def test_month_run_stages_only_its_companies_and_dates(tables):
    buffer = TaxBuffer(tables, MONTH, master="31")
    mine = {r["comp_scala"] for r in buffer.scope.collect()}
    got = buffer._buffer().select("comp_scala", F.year("book_date"), F.month("book_date")).distinct().collect()
    assert got and {r[0] for r in got} <= mine and {tuple(r[1:]) for r in got} == {(MONTH.year, MONTH.month)}


def test_wraps_need_no_invoices(tables):
    assert "orders" not in plan(TaxBuffer(tables)._wraps())


def test_branches_of_a_staged_run_read_the_joined_ledger(tables):
    """The buffer meets accounts and customers once, not once per branch."""
    text = physical(TaxBuffer(tables).stage().publish())
    assert "/buffer-" not in text and "/ledger-" in text


def test_invoices_are_joined_after_accounts_and_customers(tables):
    buffer = TaxBuffer(tables)
    for branch in (buffer.grouped_payments, buffer.payments, buffer.accruals):
        joins = [line for line in physical(branch()).splitlines() if "Join" in line]
        at = lambda key: next(i for i, line in enumerate(joins) if key in line)
        assert at("[invoice#") < at("org_code#") < at("acc#")


def test_staged_price_tables_grow_with_prices_alone(spark, monkeypatch):
    from saldo.operators import asof
    written, staged = [], asof.staged
    monkeypatch.setattr(asof, "staged", lambda df, name: (lambda out: (written.append(out.count()), out)[1])(staged(df, name)))
    prices = spark.range(20).select(
        F.lit("a").alias("kodtov"), F.col("id").cast("decimal(10,2)").alias("cena"), "id",
        F.expr("timestamp_ntz'2024-01-02 10:00:00' + make_dt_interval(0, 0, 0, 30 * id)").alias("data"))
    lines = spark.range(1440 * 3).select(
        F.lit("a").alias("kodtov"), "id", F.expr("timestamp_ntz'2024-01-01 00:00:15' + make_dt_interval(0, 0, id)").alias("at"))
    found = {r["at"]: (r["price"], r["previous_price"]) for r in pricing.prices_before(lines, prices, "at").collect()}
    assert max(written) <= 20
    for at, (price, before) in found.items():
        day = [r for r in range(20) if (at.day, at.hour * 3600 + at.minute * 60 + at.second) > (2, 36000 + 30 * r)]
        assert (price, before) == (max(day) if day else None, None)
