"""Companies in scope and the dimension tables that belong to them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.functions.text import clean_tax_number
from saldo.operators.guards import require_unique

Tables = Mapping[str, DataFrame]

# Kinds of object a company is linked to an example set for.
CUSTOMERS, CHART, WRITEOFFS = 1, 5, 13


def company_sets(tables: Tables) -> DataFrame:
    """One row per company with the example set it uses for each kind of object.

    A company with two sets of one kind fails the job, as a scalar subquery would.
    """
    kinds = {CUSTOMERS: "customer_set", CHART: "chart_set", WRITEOFFS: "writeoff_set"}
    mine = lambda kind: F.when(F.col("id_object") == kind, F.col("id_example"))
    message = F.concat(F.lit("several example sets for company "), F.col("id_company").cast("string"))
    sets = (
        tables["company_objects_links"].groupBy("id_company")
        .agg(*[F.max(mine(kind)).alias(name) for kind, name in kinds.items()],
             F.greatest(*[F.count(mine(kind)) for kind in kinds]).alias("most"))
        .filter(F.when(F.col("most") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
        .drop("most")
    )
    return tables["company_main"].join(sets, "id_company", "left")


def company_scope(tables: Tables, master: str | None = None,
                  company: str | None = None) -> DataFrame:
    """Companies of a report with their master: all of one master, or one company of it; without a
    master, every company under its own. A company has one master in a run."""
    members = tables["master_comp_scala"].select(F.col("comp_master").alias("master"), "comp_scala")
    if master is not None:
        members = members.filter(F.col("master") == master)
    if company not in (None, "0", "00"):
        members = members.filter(F.col("comp_scala") == company)
    return require_unique(members, ["comp_scala"])


def chart(tables: Tables) -> DataFrame:
    """Accounts with their VAT rate and currency, unique per set, year and account."""
    return require_unique(_accounts(tables), ["chart_set", "year_v", "acc"])


def _accounts(tables: Tables) -> DataFrame:
    """An account without a known rate or currency stays, with NULL there (``cur_known`` says so)."""
    currency = tables["currency_list"].select(
        F.col("currency_code").alias("currency_id"), F.col("currency_name_rus").alias("cur"),
        F.col("currency_id").alias("cur_code"), F.lit(True).alias("cur_known"),
    )
    accounts = tables["plan_schetov"].select(
        F.col("id_example").alias("chart_set"), "year_v", F.col("account_b").alias("acc"),
        "account_name", "vat_code", "tax_acr", "tax_rd", "tax_pay", "tax_rep", "advance",
        "auto_system", F.col("purch_book").alias("pl"), "currency_id",
    )
    return (
        accounts
        .join(tables["vat_codes"].select("vat_code", F.col("vat_prc").alias("vat")),
              "vat_code", "left")
        .join(currency, "currency_id", "left")
    )


def plan_of_scope(tables: Tables, sets: DataFrame) -> DataFrame:
    """Accounts of all sets that companies of a master use, unique per master, year and account.
    ``sets`` holds the companies in scope with their master and example sets."""
    used = sets.filter("chart_set is not null").select("master", "chart_set").distinct()
    return require_unique(_accounts(tables).join(used, "chart_set"), ["master", "year_v", "acc"])


def writeoff_map(tables: Tables) -> DataFrame:
    """Write-off account for an account and write-off type, per set and year."""
    return tables["wo_accounts_map"].select(
        F.col("id_example").alias("writeoff_set"), "year_v", F.col("account_b").alias("acc"),
        "wo_type", "wo_account",
    )


def customers(tables: Tables) -> DataFrame:
    """Customers with the parent they report to, both from the same set.

    The parent is joined here, customer to customer, so that the ledger needs one join for both.
    ``is_child`` is NULL for a customer without a parent id: such a customer passes neither the
    "own parent" nor the "child" test. Two parents with one id in a set fail the job.
    """
    own = tables["organizations"].select(
        F.col("id_example").alias("customer_set"), "organization_id", "org_code", "org_name",
        "inn", clean_tax_number(F.col("inn")).alias("clean_inn"), "kpp", "report_org_id",
        (F.col("organization_id") != F.col("report_org_id")).alias("is_child"),
    )
    parent = tables["organizations"].select(
        F.col("id_example").alias("customer_set"), F.col("organization_id").alias("report_org_id"),
        F.col("org_code").alias("parent_code"), F.col("org_name").alias("parent_name"),
        F.col("inn").alias("parent_inn"), F.col("kpp").alias("parent_kpp"),
        F.col("report_org_id").alias("parent_report_id"), F.lit(True).alias("parent_known"),
    )
    parent = require_unique(parent, ["customer_set", "report_org_id"])
    return own.join(parent, ["customer_set", "report_org_id"], "left")
