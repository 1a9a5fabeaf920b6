"""The consolidated tax buffer: many companies, their payment ledgers, ten branches, one book.

Like the sales book it covers all masters, companies and months at once; a period, a master or a
company only filters. Every movement meets its invoice once, in the operations buffer, and its
account and customer once; the branches are rules over the result.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.dates import Period, in_period, month_end
from saldo.functions.money import (
    MONEY, RATES_BUFFER, cents, local_amount, measures, money, signs_agree,
)
from saldo.functions.text import doc_key, or_blank
from saldo.operators.guards import dimension
from saldo.operators.reload import delete_matching, delete_where
from saldo.plans.book import WRITEOFF_KEYS, writeoff_flag
from saldo.plans.postings import PERCENT, Posting, post, shaped, summed
from saldo.session import staged
from saldo.sources.tables import trim_keys
from saldo.plans.scope import (
    Tables, company_scope, company_sets, customers, plan_of_scope, writeoff_map,
)

SUMS = measures(RATES_BUFFER)
SIGNED = [*SUMS, "amount_loc"]
BRANCH_COLUMNS = [
    "factura", "f_date", "cust_name", "inn", "kpp", "paydate", "fact_amt", "base20", "vat20",
    "base18", "vat18", "base0", "export", "pay_doc", "inv", "inv_date", "cur", "inv_amt", "vat",
    "inv_base", "inv_vat", "prc", "acc", "trans", "cust_code", "comp_scala", "type", "amount_loc",
    "calc_rd", "trans_rd", "invoice_no_cred", "comp_scala_cred",
]
# the stored book keeps 18 % in the columns named 10
BOOK_COLUMNS = [
    "factura", "f_date", "cust_name", "inn", "kpp", "paydate", "fact_amt", "base20", "vat20",
    "base10", "vat10", "base0", "export", "pay_doc", "inv", "inv_date", "cur", "inv_amt", "vat",
    "inv_base", "inv_vat", "no_tax", "prc", "acc", "trans", "cust_code", "comp_scala", "type",
    "amount_loc", "calc_rd", "trans_rd", "invoice_no_cred", "comp_scala_cred",
]
UNGROUPED_COLUMNS = [
    "comp_scala", "factura", "f_date", "cust_name", "inn", "kpp", "paydate", "fact_amt", "inv_amt",
    "amount_loc", "base20", "vat20", "base18", "vat18", "base0", "export", "pay_doc", "inv",
    "inv_date", "cur", "vat", "vat_code", "cur_code", "inv_base", "inv_vat", "prc", "acc", "trans",
    "cust_code", "type", "pay_line", "trans_rd", "calc_rd", "invoice_no_cred", "comp_scala_cred",
    "invoice_billing_moving", "advance_wrap",
]
GROUPED_COLUMNS = [
    "g_factura", "f_date", "g_org_code", "g_cust_name", "g_inn", "cust_name", "inn", "kpp",
    "paydate", "fact_amt", "inv_amt", "amount_loc", "base20", "vat20", "base18", "vat18", "base0",
    "export", "pay_doc", "inv", "inv_date", "cur", "vat", "vat_code", "cur_code", "inv_base",
    "inv_vat", "prc", "acc", "trans", "cust_code", "comp_scala", "type", "rep_id", "trans_rd",
    "calc_rd", "invoice_no_cred", "comp_scala_cred", "invoice_billing_moving", "advance_wrap",
]
OPERATIONS_COLUMNS = [
    "comp_scala", "customer_code", "invoice", "book_date", "trans_number", "account", "curr",
    "amount_loc", "amount_org", "pay_line", "pay_rate", "mnth", "year_v", "s", "hist_rate",
    "calc_rd", "trans_rd", "factura_number", "invoice_date", "invoice_no_cred", "comp_scala_cred",
]
# columns of the matched invoice, stored with the buffer so that no branch joins invoices again
INVOICE_COLUMNS = ["has_invoice", "invoice_book_date", "percent_value"]
TYPES = {
    **dict.fromkeys([*SIGNED, "base10", "vat10", "no_tax", "calc_rd", "trans_rd"], MONEY),
    "f_date": "date", "paydate": "date", "inv_date": "date", "vat": "int", "vat_code": "int",
    "cur_code": "int", "pay_line": "int", "prc": PERCENT, "rep_id": "bigint",
}
# Branch labels and names as the book stores them.
ACCRUALS, GROUPED_ACCRUALS = "Начисления", "Сгруппированные начисления"
DIFFERENCES, PAYMENTS, REVERSALS = "Суммовые разницы", "Платежи", "сторно"
CREDIT_WRITEOFFS, GROUPED_PAYMENTS = "Списания кредит. задолженности", "Сгруппированные платежи"
SPECIAL, WRAPPED, MOVED = "special", "advance_wrap", "billing_moving"
ROUBLE, GROUP_NAME = "РУБ.", "RG group users"


def _paid() -> Column:
    return F.col("pay_line").isNotNull()


def _local() -> Column:
    return local_amount(F.col("amount_org"), F.col("pay_rate"))


def _original() -> Column:
    return cents(F.col("amount_org"))


def _not_grouped() -> Column:
    """Account not grouped, or grouped without tax, or grouped with a customer that is its own
    parent."""
    grouped = F.col("auto_system") == 1
    return (
        (F.col("auto_system") == 0) | (grouped & (F.col("vat_code") == 0))
        | (grouped & ~F.col("is_child"))
    )


def _book_advance() -> Column:
    """Advances that the purchase book does not take: negative ones, or the account is not in it."""
    return (F.col("advance") == 1) & ((F.col("amount_org") < 0) | (F.col("pl") == 0))


def _plain_payment() -> Column:
    return (F.col("advance") == 0) & _paid()


def _branch(rows: DataFrame) -> DataFrame:
    return shaped(rows, BRANCH_COLUMNS, TYPES)


def _ledger_advance() -> Column:
    """Positive advances on accounts of the purchase book: the rows of the payment ledgers."""
    return (
        (F.col("tax_pay") == 1) & (F.col("advance") == 1) & (F.col("pl") == 1)
        & (F.col("amount_org") > 0) & F.col("vat").isNotNull() & F.col("cur_known")
    )


def operations_buffer(tables: Tables, period: Period | None = None,
                      scope: DataFrame | None = None) -> DataFrame:
    """Movements of all companies, or of those in ``scope``, with their invoice document, the credited
    invoice and the company it belongs to."""
    rows = with_invoices(tables, company_movements(tables, period, scope))
    return rows.select(*OPERATIONS_COLUMNS, *INVOICE_COLUMNS)


def company_movements(tables: Tables, period: Period | None = None,
                      scope: DataFrame | None = None) -> DataFrame:
    """Movements of all companies, or of those in ``scope``, with the id of their company."""
    movements = tables["operations_lib"]
    if scope is not None:
        movements = movements.join(scope.select("comp_scala"), "comp_scala", "left_semi")
    return movements.filter(in_period(period, F.col("book_date"))).join(
        tables["company_main"].select("comp_scala", "id_company"), "comp_scala"
    )


def with_invoices(tables: Tables, rows: DataFrame) -> DataFrame:
    """``rows`` with what the buffer takes from their invoice, if there is one."""
    companies = tables["company_main"]
    invoices = tables["invoices"].select(
        F.col("invoice_number").alias("invoice"), "id_company", "factura_number",
        "invoice_no_cred", F.col("filial_no_cred"), F.col("book_date").alias("invoice_book_date"),
        "percent_value", F.lit(True).alias("has_invoice"),
    )
    credited = companies.select(
        F.col("id_company").alias("filial_no_cred"), F.col("comp_scala").alias("comp_scala_cred")
    )
    return (
        rows.join(invoices, ["invoice", "id_company"], "left")
        .join(credited, "filial_no_cred", "left")
        .withColumns({"invoice_date": F.col("inv_book_date"),
                      "has_invoice": F.coalesce("has_invoice", F.lit(False))})
    )


def advance_wraps(movements: DataFrame) -> DataFrame:
    """Payments on advance accounts of an invoice that cancel out within a month: both signs occur
    and the sum is zero. One row per payment line and date."""
    keys = ["comp_scala", "invoice", "year_v", "mnth"]
    payments = movements.filter((F.col("advance") == 1) & _paid())
    org = F.col("amount_org")
    cancelled = payments.groupBy(*keys).agg(
        F.min(org).alias("least"), F.max(org).alias("most"), F.sum(org).alias("total")
    ).filter("least < 0 and most > 0 and total = 0")
    return payments.join(cancelled, keys, "left_semi").select(
        "comp_scala", "invoice", "pay_line", F.col("book_date").alias("pay_date")
    ).distinct()


# What a run stores first, to join it with the ledger.
DIMENSIONS = ("plan", "customers")
# Text keys of the remote feeds, which their source compares without trailing blanks.
REMOTE_KEYS = {
    "reversals": ("comp_scala", "invoice", "org_code"), "special_trans": ("comp_scala",),
    "inv_lib": ("comp_scala", "invoice", "customer_code"),
}


class TaxBuffer:
    """Ledgers and branches of one run.

    A single branch is one lazy plan. For the whole book, ``stage()`` first writes what several
    branches read (dimensions, buffer, its rows with account and customer, ledgers) to the shared folder. A run on stored tables puts
    them into ``stored`` (see ``saldo.plans.month.run_buffer``).
    """

    def __init__(self, tables: Tables, period: Period | None = None, master: str | None = None,
                 company: str | None = None) -> None:
        self.tables, self.period, self.master, self.company = tables, period, master, company
        self.stored: dict[str, DataFrame] = {}

    def stage(self) -> "TaxBuffer":
        for name in ("plan", "customers", "buffer", "ledger", "wraps", "ungrouped", "grouped"):
            if name not in self.stored:
                derived = getattr(self, f"_{name}")()
                write = dimension if name in DIMENSIONS else staged
                self.__dict__[name] = self.stored[name] = write(derived, name)
        return self

    def _feed(self, name: str) -> DataFrame:
        """A table of the remote ledger, its text keys without the blanks that source pads them with."""
        return trim_keys(self.tables[name], *REMOTE_KEYS[name])

    def _get(self, name: str) -> DataFrame:
        return self.stored[name] if name in self.stored else getattr(self, f"_{name}")()

    # ---- dimensions -------------------------------------------------------------------------

    @cached_property
    def scope(self) -> DataFrame:
        scope = company_scope(self.tables, self.master, self.company)
        return dimension(scope)

    @cached_property
    def sets(self) -> DataFrame:
        """Example sets of the companies in scope. Staged, as estimated joins would look larger than the
        accounts they pick, and the accounts would be broadcast to them."""
        return dimension(company_sets(self.tables).join(self.scope, "comp_scala"))

    @cached_property
    def plan(self) -> DataFrame:
        if "plan" in self.stored:
            return self.stored["plan"]
        return dimension(self._plan())

    def _plan(self) -> DataFrame:
        return plan_of_scope(self.tables, self.sets)

    @cached_property
    def customers(self) -> DataFrame:
        """Customers of every master, with their parents of the same set."""
        if "customers" in self.stored:
            return self.stored["customers"]
        return dimension(self._customers())

    def _customers(self) -> DataFrame:
        mine = customers(self.tables).withColumn("master", F.col("customer_set").cast("string"))
        return mine.drop("customer_set")

    # ---- buffer and ledgers -----------------------------------------------------------------

    @cached_property
    def buffer(self) -> DataFrame:
        return self._get("buffer").filter(in_period(self.period, F.col("book_date")))

    def _buffer(self) -> DataFrame:
        return operations_buffer(self.tables, self.period, self.scope)

    @cached_property
    def movements(self) -> DataFrame:
        """Buffer rows of the scope with their account, from the chart of the movement's year."""
        return self._placed(self.buffer)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return (
            rows.withColumns({"acc": F.col("account"), "org_code": F.col("customer_code")})
            .drop("account")
            .join(self.scope, "comp_scala")
            .join(self.plan, ["master", "year_v", "acc"])
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """Movements of known customers."""
        return self._get("ledger")

    def _ledger(self) -> DataFrame:
        """From a stored buffer, which has the invoices. Without one they are joined last, when accounts,
        customers and the rules of the branch have taken out most movements."""
        if "buffer" in self.stored:
            return self._known(self.movements.drop("account_name", "tax_rep", "s", "curr", "hist_rate"))
        return with_invoices(self.tables, self._known(self._placed(
            company_movements(self.tables, self.period, self.scope)
        )))

    def _known(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.customers, ["master", "org_code"])

    @cached_property
    def wraps(self) -> DataFrame:
        return self._get("wraps")

    def _wraps(self) -> DataFrame:
        """Invoices play no part, so without a stored buffer the ledger is read without them."""
        if "buffer" in self.stored:
            return advance_wraps(self.movements)
        rows = self.tables["operations_lib"].filter(in_period(self.period, F.col("book_date"))).join(
            self.tables["company_main"].select("comp_scala"), "comp_scala", "left_semi"
        )
        return advance_wraps(self._placed(rows.select(
            "comp_scala", "customer_code", "invoice", "book_date", "account", "amount_org", "pay_line",
            "mnth", "year_v",
        )))

    @cached_property
    def moved(self) -> DataFrame:
        """Invoices moved in billing."""
        return staged(self.tables["billing_moving"].select(
            "comp_scala", "invoice", F.col("invoice").alias("invoice_billing_moving")
        ).distinct(), "moved")

    def _with_flags(self, rows: DataFrame) -> DataFrame:
        """Mark accruals moved in billing and payments that were wrapped. Rows that cannot match
        keep NULL; the marks never multiply rows."""
        moved = self.moved
        wraps = self.wraps if "wraps" in self.stored else staged(self.wraps, "wraps")
        wrapped = wraps.select(
            "comp_scala", "invoice", "pay_line", F.col("pay_date").alias("book_date"),
            F.col("invoice").alias("advance_wrap"),
        )
        on = (
            (rows["comp_scala"] == moved["comp_scala"]) & (rows["invoice"] == moved["invoice"])
            & rows["pay_line"].isNull()
        )
        return rows.join(moved, on, "left").drop(moved["comp_scala"], moved["invoice"]).join(
            wrapped, ["comp_scala", "invoice", "pay_line", "book_date"], "left"
        )

    @cached_property
    def ungrouped(self) -> DataFrame:
        """Payment ledger of accounts that are not grouped, one row per movement. It takes the
        advances that the grouped ledger leaves out, so no movement is in both."""
        return self._get("ungrouped").filter(in_period(self.period, F.col("paydate")))

    def _ungrouped(self) -> DataFrame:
        return self._ungrouped_rows(self._with_flags(self.ledger))

    def _ungrouped_rows(self, movements: DataFrame) -> DataFrame:
        day = F.col("book_date")
        posting = Posting(
            PAYMENTS, _ledger_advance() & ((F.col("auto_system") == 0) | (F.col("vat_code") == 0)),
            gross=_local(), inv_gross=_original(),
            fact_amt=cents(money(F.col("amount_org") * F.col("pay_rate"))),
        )
        rows = post(movements, [posting], RATES_BUFFER)
        return shaped(rows.withColumns({
            "factura": F.col("invoice"), "f_date": day, "paydate": day, "inv_date": day,
            "cust_name": F.col("org_name"), "inn": or_blank(F.col("inn"), " "),
            "kpp": or_blank(F.col("kpp"), " "), "amount_loc": cents(F.col("amount_loc")),
            "inv": F.col("invoice"), "trans": F.col("trans_number"), "cust_code": F.col("org_code"),
        }), UNGROUPED_COLUMNS, TYPES)

    @cached_property
    def grouped(self) -> DataFrame:
        """Payment ledger of grouped accounts: per invoice for customers that are their own parent,
        per parent and month for child customers. Rows are summed per booking day, which the output
        does not show."""
        return self._get("grouped").filter(in_period(self.period, F.col("paydate")))

    def _grouped(self) -> DataFrame:
        posting = Posting(
            GROUPED_PAYMENTS,
            _ledger_advance() & (F.col("auto_system") == 1) & (F.col("vat_code") != 0)
            & F.col("is_child").isNotNull(),
            gross=_local(), inv_gross=_original(),
            fact_amt=cents(money(F.col("amount_org") * F.col("pay_rate"))),
        )
        rows = post(self._with_flags(self.ledger), [posting], RATES_BUFFER).withColumn(
            "amount_loc", cents(F.col("amount_loc"))
        )
        sums = [*SUMS, "amount_loc", "trans_rd", "calc_rd"]
        keys = ["comp_scala", "book_date", "acc", "cur", "vat", "vat_code", "cur_code", "type",
                "invoice_billing_moving", "advance_wrap"]
        tag = lambda inn, kpp: F.concat(
            or_blank(F.col(inn)), or_blank(F.concat(F.lit("/"), F.col(kpp)))
        )
        trans = F.max("trans_number").alias("trans")

        own = summed(
            rows.filter(~F.col("is_child")),
            [*keys, "invoice", "org_code", "org_name", "inn", "kpp", "report_org_id"], sums, trans,
        ).withColumns({
            "g_factura": F.col("invoice"), "g_org_code": F.col("org_code"),
            "g_cust_name": F.col("org_name"), "g_inn": tag("inn", "kpp"),
            "cust_name": F.col("org_name"), "inn": or_blank(F.col("inn"), " "),
            "kpp": or_blank(F.col("kpp"), " "), "inv": F.col("invoice"),
            "cust_code": F.col("org_code"), "rep_id": F.col("report_org_id"),
        })
        key = doc_key("RG_", F.col("parent_code"), F.col("acc"), F.col("book_date"))
        child = summed(
            rows.filter("is_child"),
            [*keys, "parent_code", "parent_name", "parent_inn", "parent_kpp", "parent_report_id"],
            sums, trans,
        ).withColumns({
            "g_factura": key, "g_org_code": F.col("parent_code"),
            "g_cust_name": F.col("parent_name"), "g_inn": tag("parent_inn", "parent_kpp"),
            "cust_name": F.lit(GROUP_NAME), "inn": F.lit(" "), "kpp": F.lit(" "), "inv": key,
            "cust_code": F.col("parent_code"), "rep_id": F.col("parent_report_id"),
        })
        end = month_end(F.col("book_date"))
        stored = {"f_date": end, "paydate": end, "inv_date": end,
                  "invoice_no_cred": F.lit(""), "comp_scala_cred": F.lit("")}
        return reduce(DataFrame.unionByName, [
            shaped(part.withColumns(stored), GROUPED_COLUMNS, TYPES) for part in (own, child)
        ])

    # ---- branches over movements ------------------------------------------------------------

    def _described(self, rows: DataFrame) -> DataFrame:
        """Columns that most row-level branches share."""
        return rows.withColumns({
            "cust_name": F.col("org_name"), "inn": F.col("clean_inn"),
            "kpp": or_blank(F.col("kpp")), "inv": F.col("invoice"),
            "inv_date": F.col("book_date"), "trans": F.col("trans_number"),
            "cust_code": F.col("customer_code"),
        })

    def _accruals(self) -> Posting:
        loc = F.col("amount_loc")
        return Posting(
            ACCRUALS,
            (F.col("tax_acr") == 1) & _not_grouped() & ~_paid() & F.col("has_invoice")
            & F.col("cur_known"),
            gross=cents(loc), inv_gross=_original(), fact_amt=loc,
            values={"factura": F.col("factura_number"), "f_date": F.col("invoice_book_date"),
                    "paydate": F.lit(None).cast("date"), "cur": F.col("cur"),
                    "prc": F.col("percent_value").cast(PERCENT), "amount_loc": loc},
        )

    def _differences(self) -> Posting:
        rd = cents(F.col("calc_rd"))
        return Posting(
            DIFFERENCES,
            (F.col("tax_rd") == 1) & _paid()
            & signs_agree(F.col("calc_rd"), -F.col("amount_org")) & (rd != 0),
            gross=rd, inv_gross=_local(),
            values={"factura": F.col("factura_number"), "f_date": F.col("invoice_book_date"),
                    "paydate": F.col("book_date"), "cur": F.lit(ROUBLE),
                    "prc": F.col("percent_value").cast(PERCENT), "amount_loc": -F.col("amount_loc")},
        )

    def _payments(self) -> Posting:
        advance = F.col("advance") == 1
        no_document = advance | F.col("factura_number").isNull()
        return Posting(
            PAYMENTS,
            (F.col("tax_pay") == 1) & _not_grouped() & (_book_advance() | _plain_payment())
            & F.col("cur_known"),
            gross=-_local(), inv_gross=-_original(),
            values={
                "factura": F.when(no_document, F.col("invoice")).otherwise(F.col("factura_number")),
                "f_date": F.when(advance, F.col("book_date")).otherwise(F.col("invoice_date")),
                "paydate": F.col("book_date"), "cur": F.col("cur"),
                "prc": F.lit(0).cast(PERCENT), "amount_loc": -F.col("amount_loc"),
            },
        )

    def _without_reversed(self, rows: DataFrame) -> DataFrame:
        return delete_matching(
            rows, self._feed("reversals").select("comp_scala", "invoice", "trans_number"),
            ["comp_scala", "invoice", "trans_number"],
        )

    def accruals(self) -> DataFrame:
        return _branch(post(self._described(self.ledger), [self._accruals()], RATES_BUFFER))

    def differences(self) -> DataFrame:
        return _branch(post(self._described(self.ledger), [self._differences()], RATES_BUFFER))

    def payments(self) -> DataFrame:
        """Payments that were not reversed later."""
        posting = self._payments()
        kept = self._without_reversed(self.ledger.filter(posting.rule))
        return _branch(post(self._described(kept), [posting], RATES_BUFFER))

    def accruals_and_differences(self) -> DataFrame:
        """Both in one pass over the ledger."""
        postings = [self._accruals(), self._differences()]
        return _branch(post(self._described(self.ledger), postings, RATES_BUFFER))

    def grouped_accruals(self) -> DataFrame:
        """Accruals of child customers, per parent, booking day, invoice day and transaction."""
        loc = F.col("amount_loc")
        posting = Posting(
            GROUPED_ACCRUALS,
            (F.col("tax_acr") == 1) & (F.col("auto_system") == 1) & (F.col("vat_code") != 0)
            & F.col("is_child") & F.col("parent_known") & ~_paid() & F.col("has_invoice")
            & F.col("cur_known"),
            gross=cents(loc), inv_gross=_original(),
            values={"prc": F.col("percent_value").cast(PERCENT)},
        )
        rows = post(self.ledger, [posting], RATES_BUFFER)
        keys = ["comp_scala", "book_date", "parent_code", "parent_name", "invoice_book_date", "cur",
                "vat", "prc", "acc", "trans_number", "type"]
        grouped = summed(
            rows, keys, [*SIGNED, "calc_rd", "trans_rd"],
            F.min("invoice_no_cred").alias("invoice_no_cred"),
            F.min("comp_scala_cred").alias("comp_scala_cred"),
        )
        key = doc_key("RG_", F.col("parent_code"), F.col("acc"), F.col("invoice_book_date"))
        return _branch(grouped.withColumns({
            "factura": key, "inv": key, "f_date": F.col("book_date"),
            "inv_date": F.col("book_date"), "cust_name": F.col("parent_name"), "inn": F.lit(" "),
            "kpp": F.lit(" "), "trans": F.col("trans_number"), "cust_code": F.col("parent_code"),
        }))

    def writeoffs(self) -> DataFrame:
        """Written-off advances: one row per matching line of the write-off list and map."""
        listed = self.tables["writeoff_list"].select(
            *[F.col(theirs).alias(ours) for ours, theirs in WRITEOFF_KEYS.items()], "wo_type"
        ).filter(in_period(self.period, F.col("book_date")))
        sets = self.sets.filter("writeoff_set is not null").select(
            "master", "writeoff_set"
        ).distinct()
        mapped = dimension(
            writeoff_map(self.tables).join(sets, "writeoff_set")
            .select("master", "year_v", "acc", "wo_type")
        )
        day = F.col("book_date")
        posting = Posting(
            CREDIT_WRITEOFFS,
            (F.col("tax_pay") == 1) & (F.col("advance") == 1) & _paid() & F.col("cur_known"),
            gross=_local(), inv_gross=_original(),
            values={"factura": F.col("invoice"), "f_date": day, "paydate": day,
                    "prc": F.lit(0).cast(PERCENT)},
        )
        rows = self.ledger.filter(posting.rule).join(listed, list(WRITEOFF_KEYS)).join(
            mapped, ["master", "year_v", "acc", "wo_type"]
        )
        return _branch(post(self._described(rows), [posting], RATES_BUFFER))

    def grouped_payments(self) -> DataFrame:
        """Payments of child customers on grouped accounts, per parent and month. An advance counts
        only while it is not written off."""
        rule = (
            (F.col("tax_pay") == 1) & (F.col("auto_system") == 1) & F.col("is_child")
            & F.col("cur_known")
        )
        posting = Posting(
            GROUPED_PAYMENTS, (_book_advance() & ~F.col("written_off")) | _plain_payment(),
            gross=-_local(), inv_gross=-_original(),
            values={"paydate": month_end(F.col("book_date")), "amount_loc": -F.col("amount_loc")},
        )
        candidates = self.ledger.filter(rule & (_book_advance() | _plain_payment()))
        flagged = writeoff_flag(candidates, self.tables["writeoff_list"], self.period, self.scope)
        rows = post(flagged, [posting], RATES_BUFFER)
        keys = ["comp_scala", "paydate", "parent_code", "parent_name", "cur", "vat", "acc", "type",
                "invoice_no_cred", "comp_scala_cred"]
        grouped = summed(
            rows, keys, [*SIGNED, "calc_rd", "trans_rd"],
            F.min("parent_inn").alias("parent_inn"), F.min("parent_kpp").alias("parent_kpp"),
        )
        key = doc_key("RG_", F.col("parent_code"), F.col("acc"), F.col("paydate"))
        return _branch(grouped.withColumns({
            "factura": key, "inv": key, "f_date": F.col("paydate"), "inv_date": F.col("paydate"),
            "cust_name": F.col("parent_name"), "inn": or_blank(F.col("parent_inn")),
            "kpp": or_blank(F.col("parent_kpp")), "trans": F.lit(" "),
            "cust_code": F.col("parent_code"),
        }))

    def reversals(self) -> DataFrame:
        """Payments reversed in the remote ledger, at the rate of the reversal day. Currency and
        account come from the invoice."""
        feed = self._feed("reversals").filter(in_period(self.period, F.col("rev_date"))).select(
            "comp_scala", "invoice", F.col("org_code").alias("cust_code"), "trans_number",
            "rev_date", "amount_loc", "amount_org", F.year("rev_date").alias("year_v"),
        )
        invoices = self._feed("inv_lib").select(
            "comp_scala", "invoice", F.col("account").alias("acc"),
            F.col("customer_code").alias("org_code"), F.col("curr"), F.col("inv_book_date"),
        )
        names = self.tables["currency_list"].select(
            F.col("currency_code").alias("curr"), F.col("currency_name_rus").alias("cur")
        )
        # at most one row per day of the period and currency pair
        rates = self.tables["exch_rates"].filter(in_period(self.period, F.col("rate_date"))).select(
            F.col("rate_date").alias("rev_date"), F.col("src_curr").alias("curr"),
            F.col("trg_curr").alias("base_curr"), F.col("rate").alias("pay_rate"),
        )
        bases = self.tables["company_main"].select("comp_scala", "base_curr")
        posting = Posting(
            REVERSALS, (F.col("tax_pay") == 1) & _not_grouped(),
            gross=-_local(), inv_gross=-_original(),
            values={"factura": F.col("invoice"), "f_date": F.col("rev_date"),
                    "paydate": F.col("rev_date"), "prc": F.lit(0).cast(PERCENT),
                    "amount_loc": -F.col("amount_loc")},
        )
        rows = (
            feed.join(self.scope, "comp_scala").join(bases, "comp_scala")
            .join(invoices, ["comp_scala", "invoice"])
            .join(self.plan.drop("cur"), ["master", "year_v", "acc"])
            .join(self.customers, ["master", "org_code"])
            .join(names, "curr")
            .join(rates, ["rev_date", "base_curr", "curr"])
        )
        return _branch(post(rows, [posting], RATES_BUFFER).withColumns({
            "cust_name": F.col("org_name"), "inn": F.col("clean_inn"),
            "kpp": or_blank(F.col("kpp")), "inv": F.col("invoice"),
            "inv_date": F.col("inv_book_date"), "trans": F.col("trans_number"),
        }))

    # ---- branches over the ledgers ----------------------------------------------------------

    def special(self) -> DataFrame:
        """Ledger payments that a feed marks as special, with the sign turned."""
        # the marks of the ledger play no part here, so an unstored ledger is built without them
        ledger = self.ungrouped if "ungrouped" in self.stored else self._ungrouped_rows(self.ledger)
        rows = ledger.filter(in_period(self.period, F.col("f_date"))).join(
            self.scope.select("comp_scala"), "comp_scala", "left_semi"
        )
        feed = self._feed("special_trans").select(
            "comp_scala", F.col("year_v"), F.col("trans_number").alias("trans")
        )
        marked = rows.withColumn("year_v", F.year("f_date")).join(
            feed, ["comp_scala", "year_v", "trans"]
        )
        turned = {m: -F.col(m) for m in SUMS}
        return _branch(marked.withColumns({
            **turned, "type": F.lit(SPECIAL), "calc_rd": F.lit(0), "trans_rd": F.lit(0)
        }))

    def flagged(self) -> DataFrame:
        """Ungrouped ledger advances that were wrapped or moved, taken back."""
        return self._taken_back(self.ungrouped, "factura", "cust_code")

    def flagged_grouped(self) -> DataFrame:
        """The same for the grouped ledger."""
        return self._taken_back(self.grouped, "g_factura", "g_org_code")

    def _taken_back(self, ledger: DataFrame, document: str, customer: str) -> DataFrame:
        wrapped = F.col("advance_wrap").isNotNull()
        rows = ledger.filter(wrapped | F.col("invoice_billing_moving").isNotNull()).select(
            F.col(document).alias("document"), F.col(customer).alias("org_code"), "comp_scala",
            "paydate", "acc", "trans", "amount_loc", F.col("inv_amt").alias("org_amt"),
            "advance_wrap", F.year("paydate").alias("year_v"),
        ).join(self.scope, "comp_scala").join(self.plan, ["master", "year_v", "acc"]).join(
            self.customers, ["master", "org_code"]
        )
        loc = F.col("amount_loc")
        posting = Posting(
            F.when(wrapped, WRAPPED).otherwise(MOVED), F.col("cur_known"),
            gross=-cents(loc), inv_gross=-cents(F.col("org_amt")), fact_amt=-loc,
            values={"amount_loc": -loc},
        )
        return _branch(post(rows, [posting], RATES_BUFFER).withColumns({
            "factura": F.col("document"), "inv": F.col("document"), "f_date": F.col("paydate"),
            "inv_date": F.col("paydate"), "cust_name": F.col("org_name"),
            "inn": F.col("clean_inn"), "kpp": or_blank(F.col("kpp")),
            "cust_code": F.col("org_code"),
        }))

    # ---- publish and clean up ---------------------------------------------------------------

    def publish(self) -> DataFrame:
        """All branches as rows of the stored book."""
        branches = [
            self.accruals_and_differences(), self.grouped_accruals(), self.payments(),
            self.reversals(), self.writeoffs(), self.grouped_payments(), self.special(),
            self.flagged(), self.flagged_grouped(),
        ]
        book = reduce(DataFrame.unionByName, branches).withColumns({
            "no_tax": F.col("base0"), "base10": F.col("base18"), "vat10": F.col("vat18"),
            "inn": F.substring("inn", 1, 20),
        })
        return shaped(book, BOOK_COLUMNS, TYPES)

    def clean_ungrouped(self) -> DataFrame:
        """The ungrouped ledger without reversed, special, moved and wrapped payments. Reversals and
        special payments leave whatever their month."""
        left = self.ungrouped.withColumn("_year", F.year("f_date"))
        for feed, keys in self._removal_feeds():
            left = delete_matching(left, feed, keys)
        return self._without_flagged(left.drop("_year"))

    def _removal_feeds(self) -> list[tuple[DataFrame, list[str]]]:
        """Reversals and special payments with the keys that tie them to the ungrouped ledger."""
        trans = F.col("trans_number").alias("trans")
        reversals = self._feed("reversals").select("comp_scala", F.col("invoice").alias("inv"), trans)
        special = self._feed("special_trans").select(
            "comp_scala", F.col("year_v").alias("_year"), trans
        )
        return [
            (reversals, ["comp_scala", "inv", "trans"]), (special, ["comp_scala", "_year", "trans"]),
        ]

    def leaving_ungrouped(self) -> DataFrame:
        """The rows that ``clean_ungrouped`` takes out; a row that two rules meet comes twice."""
        dated = self.ungrouped.withColumn("_year", F.year("f_date"))
        gone = [dated.join(feed, keys, "left_semi") for feed, keys in self._removal_feeds()]
        return reduce(DataFrame.unionByName, gone, dated.filter(self._flagged())).drop("_year")

    def leaving_grouped(self) -> DataFrame:
        """The rows that ``clean_grouped`` takes out."""
        return self.grouped.filter(self._flagged())

    def clean_grouped(self) -> DataFrame:
        """The grouped ledger without moved and wrapped payments."""
        return self._without_flagged(self.grouped)

    def _without_flagged(self, ledger: DataFrame) -> DataFrame:
        return delete_where(ledger, self._flagged())

    def _flagged(self) -> Column:
        flagged = F.col("invoice_billing_moving").isNotNull() | F.col("advance_wrap").isNotNull()
        return flagged & in_period(self.period, F.col("paydate"))


def tax_buffer(tables: Tables, period: Period | None = None, master: str | None = None,
               company: str | None = None) -> DataFrame:
    """The whole book of a run, without storing the book itself."""
    return TaxBuffer(tables, period, master, company).stage().publish()
