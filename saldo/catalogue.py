"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.functions import dates, money, text
from saldo.functions.dates import Period
from saldo.operators import balance, chains, dedup, guards, keys, lookup, pricing, ranking, reload
from saldo.plans import scope, snapshots
from saldo.plans.book import SalesBook, writeoff_flag
from saldo.plans.buffer import OPERATIONS_COLUMNS, TaxBuffer, advance_wraps, tax_buffer
from saldo.plans.sql import register_ledger
from saldo.session import configure, scratch_path
from saldo.sources.demo_views import view_text
from saldo.sources.plain import plain
from saldo.sources.tables import DemoTables, read_sheet, trim_keys
from saldo.streaming.snapshots import read_stream, stream_snapshots

MONTH = Period(1996, 12)
AS_OF = date(2024, 1, 30)
MIDDLE = date(2024, 1, 15)
SNAPSHOT_AT = datetime(2024, 1, 30, 12, 0, 0)
Query = Callable[[DemoTables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def run_query(name: str, spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return plain(QUERIES[name](DemoTables(spark, folder)))


# ---- balances, statistics, groups -----------------------------------------------------------


@query
def day_balance(t):
    ledger = t["operations"]
    return balance.daily_balance(
        ledger.filter("pay_line is null"), ledger.filter("pay_line is not null"),
        "comp_scala", "book_date", "amount_org",
    )


@query
def signed_stats(t):
    return balance.signed_stats(t["operations"], "amount_org")


@query
def top_groups(t):
    return ranking.top_n(t["orders"], "o_custkey", 3, "o_orderpriority")


@query
def low_average_groups(t):
    joined = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    salaries = joined.withColumn("salary", money.money(F.col("c_acctbal")))
    low = ranking.groups_with_average_below(salaries, "n_name", "salary", 4500)
    return low.withColumn("average", F.round("average", 4))


# ---- duplicates -----------------------------------------------------------------------------


@query
def latest_per_key(t):
    return dedup.keep_latest(t["events"], ["user_id", "event_type"], ["ts", "event_id"])


@query
def superseded_pairs(t):
    return dedup.drop_superseded(t["orders"], ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def superseded_rows(t):
    return dedup.superseded(t["orders"], ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def exact_duplicates(t):
    return dedup.exact_duplicates(
        t["operations"].select("comp_scala", "account", "pay_line", "book_date")
    )


@query
def distinct_rows(t):
    return dedup.drop_exact_duplicates(
        t["operations"].select("comp_scala", "account", "pay_line", "book_date")
    )


@query
def bulk_dedup_slices(t):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    return dedup.bulk_dedup(t["lineitem"], ["l_orderkey", "l_linenumber"], order, 8)


@query
def bulk_dedup_in_place(t):
    """A stored table in slices, cleaned where it lies."""
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]
    path = scratch_path(t.spark, "sliced")
    keys = ["l_orderkey", "l_linenumber"]
    dedup.lay_in_slices(t["lineitem"], path, keys, 8)
    return dedup.dedup_in_place(t.spark, path, keys, order, 8).drop(dedup.SLICE)


# ---- prices, lookups, chains, ids -----------------------------------------------------------


@query
def price_before_day(t):
    return pricing.price_before(t["k_kodtov"], t["ch_price"], datetime(2024, 1, 16))


@query
def price_next_day_effective(t):
    return pricing.price_effective(t["k_kodtov"], t["ch_price"], datetime(2024, 1, 16, 0, 0, 1))


def price_lines(t):
    """Ledger lines of the suppliers' goods, with a moment in the first months of the price history."""
    hours = (F.dayofyear("l_shipdate") - 1) * 4 + F.col("l_linenumber")
    moment = F.expr("timestamp_ntz'2024-01-01 00:00:00'") + F.make_dt_interval(hours=hours, mins=F.col("l_quantity").cast("int"))
    return t["lineitem"].select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("kodtov"), moment.alias("moment"))


@query
def price_of_lines_effective(t):
    """Every line with the price valid on its own day and the one before."""
    return pricing.prices_effective(price_lines(t), t["ch_price"], "moment")


@query
def price_of_lines_before(t):
    """Every line with the last price before its own moment and that of an earlier day."""
    return pricing.prices_before(price_lines(t), t["ch_price"], "moment")


@query
def lookup_policies(t):
    names = t["events"].select(F.col("user_id").alias("pid"), "event_type", "ts", "event_id")
    cards = t["customer"].select(F.col("c_custkey").alias("pid"))
    last = {"on_many": "last", "order": ["ts", "event_id"]}
    kept = lookup.lookup(cards, names, "pid", "event_type", on_empty="keep", default="XXXX", **last)
    kept = kept.withColumnRenamed("event_type", "kept")
    both = lookup.lookup(kept, names, "pid", "event_type", on_empty="null", **last)
    single = t["organizations"].select(
        F.col("organization_id").alias("pid"), F.col("org_name").alias("single")
    )
    return lookup.lookup(both, single, "pid", "single", on_empty="null", on_many="error")


@query
def chain_change_date(t):
    cards = t["card_edges"].select(F.col("old_card").alias("card")).distinct()
    return chains.change_decision(cards, t["card_edges"], hops=5, months=12)


@query
def chain_closure(t):
    return chains.chain_closure(t["card_edges"])


@query
def assign_keys(t):
    old = t["supplier"].select(F.col("s_suppkey").alias("id"))
    new = t["part"].select("p_partkey", "p_name")
    return keys.assign_ids(old, new, ["p_name", "p_partkey"])


# ---- scope and dimensions -------------------------------------------------------------------


@query
def plan_of_scope(t):
    sets = scope.company_sets(t).join(scope.company_scope(t, "31"), "comp_scala")
    return scope.plan_of_scope(t, sets).select(
        "master", "year_v", "acc", "account_name", "vat_code", "vat", "tax_acr", "tax_rd", "tax_pay",
        "tax_rep", "advance", "auto_system", "pl", "cur", "cur_code",
    )


@query
def writeoff_map(t):
    mine = scope.company_sets(t).select("comp_scala", "writeoff_set")
    return scope.writeoff_map(t).join(mine, "writeoff_set").select(
        "comp_scala", "year_v", "acc", "wo_type", "wo_account"
    )


@query
def customers_of_scope(t):
    mine = scope.company_sets(t).select("comp_scala", "customer_set")
    return scope.customers(t).join(mine, "customer_set").select(
        "comp_scala", "org_code", "report_org_id", "org_name", "organization_id", "inn",
        "parent_code", "parent_name",
    )


@query
def scope_companies(t):
    """Movements per company for a whole master and for one company of it."""
    one = lambda name, df: t["operations"].join(df, "comp_scala", "left_semi").groupBy(
        "comp_scala").agg(F.count(F.lit(1)).alias("n")).withColumn("asked", F.lit(name))
    return one("all", scope.company_scope(t, "31", "0")).unionByName(
        one("one", scope.company_scope(t, "31", "02"))
    )


# ---- the sales book -------------------------------------------------------------------------


@query
def book_accruals(t):
    return SalesBook(t).accruals()


@query
def book_differences(t):
    return SalesBook(t).differences()


@query
def book_payments(t):
    return SalesBook(t).payments()


@query
def book_writeoffs(t):
    return SalesBook(t).writeoffs()


@query
def book_grouped_payments(t):
    return SalesBook(t).grouped_payments()


@query
def book_shipment(t):
    return SalesBook(t).shipment()


@query
def book_activation(t):
    return SalesBook(t).activation()


@query
def book_all(t):
    return SalesBook(t).whole()


@query
def book_month(t):
    """The report a user asks for: one company, one month."""
    return SalesBook(t, MONTH, "02").whole()


@query
def writeoff_flags(t):
    flagged = writeoff_flag(t["operations"], t["writeoff_list"])
    return flagged.groupBy("comp_scala", "account", "written_off").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_org").alias("amount")
    )


# ---- the tax buffer -------------------------------------------------------------------------


@query
def ops_buffer(t):
    return TaxBuffer(t).buffer.select(*OPERATIONS_COLUMNS)


@query
def advance_wrap(t):
    return advance_wraps(TaxBuffer(t).movements)


@query
def ungrouped_ledger(t):
    return TaxBuffer(t).ungrouped


@query
def ledger_function(t):
    """One month of one master, selected by SQL alone."""
    name = register_ledger(t.spark, t)
    return t.spark.sql(f"select * from {name}({MONTH.year}, {MONTH.month}, '31')")


@query
def grouped_ledger(t):
    return TaxBuffer(t).grouped


@query
def buf_accruals(t):
    return TaxBuffer(t).accruals()


@query
def buf_accruals_grouped(t):
    return TaxBuffer(t).grouped_accruals()


@query
def buf_differences(t):
    return TaxBuffer(t).differences()


@query
def buf_payments(t):
    return TaxBuffer(t).payments()


@query
def buf_reversals(t):
    return TaxBuffer(t).reversals()


@query
def buf_writeoffs(t):
    return TaxBuffer(t).writeoffs()


@query
def buf_payments_grouped(t):
    return TaxBuffer(t).grouped_payments()


@query
def buf_special(t):
    return TaxBuffer(t).special()


@query
def buf_flagged(t):
    return TaxBuffer(t).flagged()


@query
def buf_flagged_grouped(t):
    return TaxBuffer(t).flagged_grouped()


@query
def buf_publish(t):
    return tax_buffer(t)


@query
def buf_month(t):
    """One month of one master, all its companies."""
    return tax_buffer(t, MONTH, "31", "0")


@query
def ledger_cleanup(t):
    run = TaxBuffer(t).stage()
    shown = ["comp_scala", "inv", "paydate", "acc", "trans", "fact_amt", "amount_loc"]
    return run.clean_ungrouped().select(*shown, F.lit("ungrouped").alias("ledger")).unionByName(
        run.clean_grouped().select(*shown, F.lit("grouped").alias("ledger"))
    )


@query
def period_reload(t):
    """Load the whole ledger, then a month of two companies again from a corrected source."""
    path = scratch_path(t.spark, "ledger")
    ledger = t["operations_lib"]
    reload.reload_period(ledger, path)
    again = ledger.filter(
        dates.in_period(MONTH, F.col("book_date")) & F.col("comp_scala").isin("01", "02")
    ).filter("amount_org > 0")
    for _ in range(2):
        reload.reload_period(again, path, MONTH, ["01", "02"])
    stored = t.spark.read.schema(ledger.schema).parquet(path)
    return stored.groupBy("year_v", "mnth", "comp_scala").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_org").alias("amount_org"),
        F.sum("amount_loc").alias("amount_loc"),
    )


@query
def period_delete(t):
    """Rows of a stored book whose dates lie outside a month; NULL dates stay."""
    return reload.delete_period(t["invoices"], MONTH, "book_date", "invoice_date").select(
        "invoice_id", "book_date", "invoice_date"
    )


# ---- activity -------------------------------------------------------------------------------


@query
def session_metrics(t):
    return snapshots.session_metrics(t["sessions"], t["proc_metrics"])


@query
def process_sessions(t):
    return snapshots.process_sessions(t["sessions"], t["proc_metrics"])


@query
def all_processes(t):
    return snapshots.all_processes(t["proc_metrics"])


HISTORY_SCHEMA = (
    "ts timestamp_ntz, pid bigint, datname string, usename string, application_name string, "
    "state_q string, query string, res_mb double, virt_mb double, swap_mb double, command string, "
    "state string, utime bigint, stime bigint, pcpu double, read_bytes bigint, write_bytes bigint, "
    "voluntary_ctxt_switches bigint, nonvoluntary_ctxt_switches bigint, threads int, day string"
)


@query
def snapshot_append(t):
    path = scratch_path(t.spark, "history")
    view = snapshots.process_sessions(t["sessions"], t["proc_metrics"])
    snapshots.append_snapshot(view, SNAPSHOT_AT, snapshots.open_days_at(AS_OF), path)
    snapshots.append_snapshot(t["history"], None, snapshots.open_days_at(AS_OF), path)
    return snapshots.read_history(t.spark, path, HISTORY_SCHEMA)


@query
def snapshot_history(t):
    """One history that the nightly job and the stream write, each twice, with retention and a read."""
    path, seen = scratch_path(t.spark, "history"), scratch_path(t.spark, "seen")
    view = snapshots.process_sessions(t["sessions"], t["proc_metrics"])
    events = read_stream(t.spark, t.folder, t["events"].schema, "events.parquet")
    history = t.spark.sql(view_text("history", "spark"), events=events)
    january = [date(2024, 1, day) for day in range(1, 31)]
    for _ in range(2):
        snapshots.append_snapshot(view, SNAPSHOT_AT, snapshots.open_days_at(AS_OF), path)
        stream_snapshots(history, path, seen, lambda: january).awaitTermination()
        snapshots.append_snapshot(view, datetime(2024, 1, 2, 3, 4, 5), january, path)
    snapshots.retain(t.spark, path, AS_OF, 3)
    return snapshots.read_history(t.spark, path, HISTORY_SCHEMA)


@query
def snapshot_route(t):
    return snapshots.route(t["history"], snapshots.open_days_at(MIDDLE)).select("ts", "pid", "day")


@query
def snapshot_retention(t):
    path = scratch_path(t.spark, "history")
    january = [date(2024, 1, day) for day in range(1, 31)]
    snapshots.append_snapshot(t["history"], None, january, path)
    snapshots.retain(t.spark, path, AS_OF, 3)
    snapshots.retain(t.spark, path, AS_OF, 3)
    return snapshots.read_history(t.spark, path, HISTORY_SCHEMA)


@query
def snapshot_stream(t):
    path, seen = scratch_path(t.spark, "history"), scratch_path(t.spark, "seen")
    events = read_stream(t.spark, t.folder, t["events"].schema, "events.parquet")
    history = t.spark.sql(view_text("history", "spark"), events=events)
    for _ in range(2):  # the second start finds nothing new
        running = stream_snapshots(history, path, seen, lambda: snapshots.open_days_at(MIDDLE))
        running.awaitTermination()
    stored = t.spark.read.schema(HISTORY_SCHEMA + ", batch int").parquet(path)
    return stored.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("utime").alias("utime"), F.max("ts").alias("last_ts")
    )


# ---- functions, filters, readers, guards ----------------------------------------------------


@query
def clean_tax_number(t):
    return t["organizations"].select("org_code", text.clean_tax_number(F.col("inn")).alias("inn"))


@query
def money_functions(t):
    org, rate = F.col("amount_org"), F.col("pay_rate")
    residual = money.rounding_residual(org, rate)
    local = money.local_amount(org, rate)
    pct = F.lit(18)
    return t["operations"].select(
        "comp_scala", "account", local.alias("local"),
        money.cents(money.vat_f(local, pct, 1)).alias("base"),
        money.cents(money.vat_f(local, pct, 2)).alias("vat"),
        (residual != 0).cast("int").alias("rounded"),
        F.signum(org).cast("int").alias("sign"),
        money.signs_agree(org, F.col("amount_loc")).cast("int").alias("agree"),
        money.cents(money.money(org * rate)).alias("twice"),
    ).groupBy("comp_scala", "account").agg(
        *[F.sum(c).alias(c) for c in ("local", "base", "vat", "rounded", "sign", "agree", "twice")]
    )


@query
def text_date_functions(t):
    day = F.col("book_date")
    at = day.cast("timestamp_ntz") + F.expr("make_dt_interval(0, percent_value, 5, 7)")
    rows = t["invoices"].withColumn("at", at)
    return rows.select(
        "invoice_number",
        text.doc_key("RG_", F.concat(F.lit(" "), "invoice_number", F.lit(" ")),
                     F.col("factura_number"), day).alias("doc"),
        text.doc_key("Act", F.col("invoice_no_cred"), F.lit("1"), day).alias("doc_or_null"),
        dates.month_end(day).alias("month_end"),
        F.add_months(day, 12).alias("next_year"), F.date_add(day, 1).alias("next_day"),
        F.date_sub(day, 1).alias("day_before"), F.to_date("at").alias("midnight"),
        dates.styled(F.col("at"), 101).alias("us"), dates.styled(F.col("at"), 103).alias("eu"),
        F.concat(dates.styled(F.col("at"), 104), F.lit(" "), dates.styled(F.col("at"), 108))
        .alias("moment"),
        F.date_format(day, "yyyyMMdd").alias("compact"),
        text.day_of_name(F.concat(F.lit("proc_"), F.date_format(day, "yyyyMMdd")), "proc_")
        .alias("named_day"),
        text.day_of_name(F.col("factura_number"), "proc_").alias("no_day"),
        F.to_timestamp_ntz(dates.styled(day, 104), F.lit("dd.MM.yyyy")).alias("day_first"),
        text.or_blank(F.col("invoice_no_cred"), "-").alias("cred"),
        F.substring("factura_number", 1, 3).alias("cut"),
    )


@query
def filters_and_sets(t):
    """Ranges, sets, NULL rules and blank- and case-blind keys over the ledger."""
    accounts = t["plan_schetov"].join(
        scope.company_sets(t).join(scope.company_scope(t, "31"), "comp_scala")
        .select(F.col("chart_set").alias("id_example")), "id_example", "left_semi",
    ).filter("tax_acr = 1").select(F.col("account_b").alias("account"))
    blank = t["operations"].withColumn("account", F.concat("account", F.lit("  ")))
    rows = trim_keys(blank, "account", ignore_case=True).filter(
        (F.col("amount_org") >= -50000) & (F.col("amount_org") < 50000)
        & (F.col("pay_line").isNull() | (F.col("pay_line") != 3))
        & dates.in_period(Period(1996), F.col("book_date")) & (F.col("comp_scala") != "05")
    ).join(accounts, "account", "left_semi")
    return rows.groupBy("comp_scala", "account").agg(
        F.count("pay_line").alias("payments"), F.sum("amount_org").alias("Сумма"),
        F.max("trans_number").alias("last trans"),
    ).orderBy(F.desc("payments"), "comp_scala", "account")


@query
def read_paths(t):
    """A sheet with a header line, a stored view and a table scan, in one report."""
    spark = t.spark
    path = scratch_path(spark, "sheet")
    t["customer"].select("c_custkey", "c_mktsegment", "c_acctbal").write.option(
        "header", True).csv(path)
    sheet = read_sheet(spark, path, "c_custkey bigint, c_mktsegment string, c_acctbal double")
    t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).createOrReplaceTempView(
        "saldo_orders_per_customer")
    per_customer = spark.table("saldo_orders_per_customer")
    return sheet.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(
        "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"),
        F.sum(money.money(F.col("c_acctbal"))).alias("balance"),
    )


@query
def unique_guard(t):
    """The invoice list behind its uniqueness guard, with the row count of the step."""
    guarded, _ = guards.counted(guards.require_unique(t["invoices"], ["invoice_number", "id_company"]),
                                "invoices")
    return guarded.groupBy("id_company").agg(
        F.count(F.lit(1)).alias("n"), F.min("invoice_no_cred").alias("first_credited"),
        F.max("trans_number").alias("last_trans"),
    )
