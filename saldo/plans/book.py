"""The sales book: seven branches of ledger movements, split by VAT rate, in one table.

A book works on all companies and months at once; a report for one company and month is the
same plan with a filter on the ledger. A company's chart of accounts, customers and write-off map
are found through its own example sets, the chart through the year of the movement.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.dates import Period, in_period, month_end
from saldo.functions.money import (
    MONEY, RATES_BOOK, cents, local_amount, measures, rounding_residual,
)
from saldo.functions.text import doc_key
from saldo.operators.guards import dimension
from saldo.plans.postings import PERCENT, Posting, post, shaped, summed
from saldo.session import staged
from saldo.plans.scope import Tables, chart, company_sets, customers, writeoff_map

MEASURES = measures(RATES_BOOK)
COLUMNS = [
    "factura", "f_date", "cust_name", "inn", "paydate", "fact_amt", "base20", "vat20", "base10",
    "vat10", "base0", "export", "pay_doc", "inv", "inv_date", "cur", "inv_amt", "vat", "inv_base",
    "inv_vat", "no_tax", "prc", "acc", "trans", "cust_code", "type", "comp_scala",
]
TYPES = {
    **dict.fromkeys(MEASURES, MONEY), "no_tax": MONEY, "f_date": "date", "paydate": "date",
    "inv_date": "date", "vat": "int", "prc": PERCENT,
}
# Columns that several branches read, of a movement with its account and of an invoice with its customer.
MOVEMENT = [
    "comp_scala", "id_company", "customer_set", "writeoff_set", "customer_code", "invoice", "book_date",
    "year_v", "trans_number", "pay_line", "amount_org", "amount_loc", "pay_rate", "acc", "vat", "cur",
    "cur_known", "tax_acr", "tax_rd", "tax_pay", "advance", "auto_system",
]
CARD_INVOICE = [
    "invoice_id", "chart_set", "year_v", "comp_scala", "book_date", "percent_value", "factura_number",
    "invoice_number", "trans_number", "org_code", "org_name", "inn", "is_child", "parent_known",
    "parent_code", "parent_name",
]
# Branch labels and currency names as the book stores them.
ACCRUALS, DIFFERENCES = "Начисления", "Суммовые разницы"
PAYMENTS, UNDER_WRITEOFF = "Платежи без РОЛ", "Под списания"
WRITEOFFS, GROUPED_PAYMENTS = "Списания с обр. знаком без рол", "Платежи рол"
SHIPMENT, ACTIVATION = "Отгрузка карт", "Активация карт"
ROUBLE_DIFFERENCES, ROUBLE_CARDS = "РУБ.", "Руб."
WRITEOFF_KEYS = {"comp_scala": "comp_scala", "invoice": "invoice_number",
                 "book_date": "trans_date", "trans_number": "trans_number"}


def _paid() -> Column:
    """A movement with a payment line is a payment, one without is an accrual."""
    return F.col("pay_line").isNotNull()


def _ungrouped() -> Column:
    return F.col("auto_system") != 1


def _local() -> Column:
    return local_amount(F.col("amount_org"), F.col("pay_rate"))


def _original() -> Column:
    return cents(F.col("amount_org"))


def _book(rows: DataFrame) -> DataFrame:
    return shaped(
        rows.withColumns({"no_tax": F.col("base0"), "inn": F.substring("inn", 1, 20)}), COLUMNS, TYPES
    )


def writeoff_flag(rows: DataFrame, writeoffs: DataFrame, period: Period | None = None,
                  companies: DataFrame | None = None, name: str = "written_off") -> DataFrame:
    """True on movements found in the write-off list. The list may repeat a movement; its keys are
    made distinct first, so the flag never multiplies rows. Only lines of the period and companies
    (column ``comp_scala``) of the report are staged."""
    listed = writeoffs.select(
        *[F.col(theirs).alias(ours) for ours, theirs in WRITEOFF_KEYS.items()], F.lit(True).alias(name)
    ).filter(in_period(period, F.col("book_date")))
    if companies is not None:
        listed = listed.join(companies.select("comp_scala"), "comp_scala", "left_semi")
    listed = staged(listed.distinct(), "writeoffs", compression="zstd")
    return rows.join(listed, list(WRITEOFF_KEYS), "left").withColumn(
        name, F.coalesce(name, F.lit(False))
    )


def _accruals() -> Posting:
    return Posting(
        ACCRUALS, (F.col("tax_acr") != 0) & _ungrouped() & ~_paid(),
        gross=_local(), inv_gross=_original(),
        values={"paydate": F.lit(None).cast("date"), "cur": F.col("cur"),
                "prc": F.col("percent_value").cast(PERCENT)},
    )


def _differences() -> Posting:
    gross = -(_local() - F.col("amount_loc"))
    return Posting(
        DIFFERENCES,
        (F.col("tax_rd") != 0) & _ungrouped() & _paid() & (rounding_residual(F.col("amount_org"), F.col("pay_rate")) != 0),
        gross=gross, inv_gross=gross,
        values={"paydate": F.col("book_date"), "cur": F.lit(ROUBLE_DIFFERENCES),
                "prc": F.col("percent_value").cast(PERCENT)},
    )


def _payments() -> Posting:
    return Posting(
        F.when(F.col("written_off"), UNDER_WRITEOFF).otherwise(PAYMENTS),
        (F.col("tax_pay") != 0) & _ungrouped() & _paid() & F.col("cur_known"),
        gross=-_local(), inv_gross=-_original(),
        values={"paydate": F.col("book_date"), "cur": F.col("cur"), "prc": F.lit(0).cast(PERCENT)},
    )


def _written_back() -> Column:
    """Advances that the write-off list may book back."""
    return (
        (F.col("tax_pay") != 0) & _ungrouped() & (F.col("advance") == 1) & _paid()
        & F.col("cur_known")
    )


def _writeoffs() -> Posting:
    return Posting(
        WRITEOFFS, F.lit(True), gross=_local(), inv_gross=_original(),
        values={"paydate": F.col("book_date"), "cur": F.col("cur"),
                "prc": F.lit(0).cast(PERCENT)},
    )


def _grouped_payments() -> Posting:
    return Posting(
        GROUPED_PAYMENTS,
        (F.col("tax_pay") != 0) & (F.col("auto_system") == 1) & F.col("cur_known")
        & ((F.col("advance") == 1) | ((F.col("advance") == 0) & _paid())),
        gross=-_local(), inv_gross=-_original(),
        values={"paydate": month_end(F.col("book_date"))},
    )


def _cards(label: str, rule: Column, day: Column) -> Posting:
    gross = -cents(F.col("amount_b"))
    return Posting(
        label, rule, gross=gross, inv_gross=gross,
        values={"paydate": day, "cur": F.lit(ROUBLE_CARDS),
                "prc": F.col("percent_value").cast(PERCENT)},
    )


def _shipped() -> Column:
    return ~F.col("is_child")


def _activated() -> Column:
    return F.col("is_child") & F.col("parent_known")


def _parent_rows(grouped: DataFrame, prefix: str, inn: Column) -> DataFrame:
    """One document per parent, account and month."""
    key = doc_key(prefix, F.col("parent_code"), F.col("acc"), F.col("paydate"))
    return grouped.withColumns({
        "factura": key, "inv": key, "f_date": F.col("paydate"), "inv_date": F.col("paydate"),
        "cust_name": F.col("parent_name"), "cust_code": F.col("parent_code"), "inn": inn,
    })


class SalesBook:
    """The branches of one book: all companies and months, or a period and company."""

    def __init__(self, tables: Tables, period: Period | None = None,
                 company: str | None = None) -> None:
        self.tables, self.period, self.company = tables, period, company

    @cached_property
    def sets(self) -> DataFrame:
        sets = dimension(company_sets(self.tables))
        return sets if self.company is None else sets.filter(F.col("comp_scala") == self.company)

    @cached_property
    def chart(self) -> DataFrame:
        return dimension(chart(self.tables))

    @cached_property
    def customers(self) -> DataFrame:
        return dimension(customers(self.tables))

    @cached_property
    def movements(self) -> DataFrame:
        """Ledger rows with their company sets and account."""
        ledger = self.tables["operations"].filter(in_period(self.period, F.col("book_date")))
        return (
            ledger.withColumns({"year_v": F.year("book_date"), "acc": F.col("account")})
            .drop("account")
            .join(self.sets, "comp_scala")
            .join(self.chart, ["chart_set", "year_v", "acc"])
        )

    def with_customer(self, rows: DataFrame) -> DataFrame:
        """Add the customer of a movement and its parent, if they are known."""
        return rows.withColumnRenamed("customer_code", "org_code").join(
            self.customers, ["customer_set", "org_code"], "left"
        )

    def with_invoice(self, rows: DataFrame) -> DataFrame:
        """Add the invoice of a movement, if there is one, its customer, and what the book takes from
        them. Customers come last: their names make the rows wide, and each join may shuffle them."""
        invoices = self.tables["invoices"].select(
            F.col("invoice_number").alias("invoice"), "id_company",
            F.col("factura_number").alias("factura"), F.col("book_date").alias("f_date"),
            "percent_value",
        )
        return self.with_customer(rows.join(invoices, ["invoice", "id_company"], "left")).withColumns({
            "cust_name": F.col("org_name"), "inv": F.col("invoice"),
            "inv_date": F.col("book_date"), "trans": F.col("trans_number"),
            "cust_code": F.col("org_code"),
        })

    def flagged(self, rows: DataFrame) -> DataFrame:
        return writeoff_flag(rows, self.tables["writeoff_list"], self.period, self.sets)

    @cached_property
    def labelled(self) -> DataFrame:
        """Movements with the flag of the write-off list."""
        return self.flagged(self.movements)

    def accruals(self) -> DataFrame:
        return _book(post(self.with_invoice(self.movements), [_accruals()], RATES_BOOK))

    def differences(self) -> DataFrame:
        """Rate differences. The filter looks at the rounding residual of the local amount while
        the measure subtracts the booked one."""
        return _book(post(self.with_invoice(self.movements), [_differences()], RATES_BOOK))

    def payments(self) -> DataFrame:
        """Payments on accounts that are not grouped, labelled by the write-off list."""
        rows = self.with_invoice(self.flagged(self.movements.filter(_paid())))
        return _book(post(rows, [_payments()], RATES_BOOK))

    def direct(self) -> DataFrame:
        """Accruals, differences and payments in one pass over the ledger."""
        rows = self.with_invoice(self.labelled)
        return _book(post(rows, [_accruals(), _differences(), _payments()], RATES_BOOK))

    @cached_property
    def booked_back(self) -> DataFrame:
        """Written-off advances on their write-off account: one row per matching line of the write-off
        list."""
        rows = self.movements.filter(_written_back())
        listed = self.tables["writeoff_list"].select(
            *[F.col(theirs).alias(ours) for ours, theirs in WRITEOFF_KEYS.items()], "wo_type"
        )
        return rows.join(
            listed.filter(in_period(self.period, F.col("book_date"))), list(WRITEOFF_KEYS)
        ).join(
            writeoff_map(self.tables), ["writeoff_set", "year_v", "acc", "wo_type"],
        ).withColumn("acc", F.col("wo_account"))

    def writeoffs(self) -> DataFrame:
        return _book(post(self.with_invoice(self.booked_back), [_writeoffs()], RATES_BOOK))

    def direct_and_writeoffs(self) -> DataFrame:
        """Both kinds of rows, joined with invoices and customers together."""
        columns = [c for c in self.labelled.columns if c != "written_off"]
        rows = self.labelled.withColumn("back", F.lit(False)).unionByName(
            self.booked_back.select(*columns, F.lit(True).alias("written_off"), F.lit(True).alias("back"))
        )
        postings = [replace(p, rule=~F.col("back") & p.rule) for p in (_accruals(), _differences(), _payments())]
        postings.append(replace(_writeoffs(), rule=F.col("back")))
        return _book(post(self.with_invoice(rows), postings, RATES_BOOK))

    def grouped_payments(self) -> DataFrame:
        """Payments on grouped accounts, one row per parent customer, account and month. Rows are
        rounded one by one and then added up."""
        rows = self.movements.filter(_grouped_payments().rule)
        rows = post(self.with_customer(rows), [_grouped_payments()], RATES_BOOK)
        keys = ["comp_scala", "paydate", "parent_code", "parent_name", "parent_inn", "cur", "vat",
                "acc", "type"]
        return _book(_parent_rows(summed(rows, keys, MEASURES), "RG_", F.col("parent_inn")))

    @cached_property
    def invoice_lines(self) -> DataFrame:
        """Lines of the invoices on accounts that report cards, with their customers. Lines meet the
        accounts with nothing but their invoice's set and year; texts are added to what is left."""
        day = F.col("book_date")
        invoices = self.tables["invoices"].filter(in_period(self.period, day)).select(
            "invoice_id", "invoice_number", "factura_number", "book_date", "id_company",
            "organization_id", "percent_value", "trans_number", F.year(day).alias("year_v"),
        )
        # numbered, as an invoice's id may repeat
        invoices = staged(
            invoices.join(self.sets, "id_company").join(self.customers, ["customer_set", "organization_id"])
            .filter(_shipped() | _activated())
            .select(*CARD_INVOICE, F.monotonically_increasing_id().alias("invoice_row")), "card-invoices",
            compression="zstd",
        )
        lines = self.tables["invoices_transactions"].select(
            "invoice_id", F.col("account_b").alias("acc"), "amount_b"
        )
        place = ["invoice_id", "chart_set", "year_v"]
        reported = (
            lines.join(invoices.select("invoice_row", *place), "invoice_id")
            .join(self.chart, ["chart_set", "year_v", "acc"]).filter("tax_rep != 0")
            .select("invoice_row", "acc", "amount_b", "vat")
        )
        return reported.join(invoices.drop(*place), "invoice_row").drop("invoice_row")

    def shipment(self) -> DataFrame:
        """Cards shipped to customers that are their own parent."""
        posting = _cards(SHIPMENT, _shipped(), F.col("book_date"))
        return _book(post(self.invoice_lines, [posting], RATES_BOOK).withColumns({
            "factura": F.col("factura_number"), "f_date": F.col("book_date"),
            "cust_name": F.col("org_name"), "inv": F.col("invoice_number"),
            "inv_date": F.col("book_date"), "trans": F.col("trans_number"),
            "cust_code": F.col("org_code"),
        }))

    def activation(self) -> DataFrame:
        """Cards activated by child customers, one row per parent, account, percent and month."""
        posting = _cards(ACTIVATION, _activated(), month_end(F.col("book_date")))
        rows = post(self.invoice_lines, [posting], RATES_BOOK)
        keys = ["comp_scala", "paydate", "parent_code", "parent_name", "cur", "vat", "prc", "acc",
                "type"]
        return _book(_parent_rows(summed(rows, keys, MEASURES), "Act", F.lit(" ")))

    def stage(self) -> None:
        """Write what several branches read: movements that meet a rule, with their accounts, and card
        lines with their customers. On files, neither ledger nor lines are shuffled again for the
        accounts, which are too many for a broadcast in a large book."""
        rules = [p().rule for p in (_accruals, _differences, _payments, _grouped_payments)]
        self.movements = staged(
            self.movements.filter(reduce(Column.__or__, [*rules, _written_back()])).select(*MOVEMENT), "movements",
            compression="zstd",
        )
        # only payments take their label from the write-off list
        pays = F.coalesce(_payments().rule, F.lit(False))
        self.labelled = self.flagged(self.movements.filter(pays)).unionByName(
            self.movements.filter(~pays).withColumn("written_off", F.lit(False))
        )
        self.invoice_lines = staged(self.invoice_lines, "card-lines", compression="zstd")

    def whole(self) -> DataFrame:
        """All branches in one table. For one company the company column is left out."""
        self.stage()
        book = reduce(DataFrame.unionByName, [
            self.direct_and_writeoffs(), self.grouped_payments(), self.shipment(), self.activation(),
        ])
        return book if self.company is None else book.drop("comp_scala")


def sales_book(tables: Tables, period: Period | None = None,
               company: str | None = None) -> DataFrame:
    return SalesBook(tables, period, company).whole()
