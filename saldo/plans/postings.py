"""Rules that turn ledger movements into book rows.

A posting is a rule and the values it books. All row-level postings of a book are applied in one
pass over the movements: a row yields one output row per rule it meets, so the ledger is scanned and
joined to its dimensions once, not once per branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.money import MONEY, cents, invoice_split, money, vat_split

PERCENT = "decimal(9,4)"


@dataclass(frozen=True)
class Posting:
    """``gross`` (signed, tax included) is split by rate; ``inv_gross`` is the same amount in the
    invoice currency; ``fact_amt`` differs from ``gross`` only where the book keeps it unrounded."""

    label: str | Column
    rule: Column
    gross: Column
    inv_gross: Column
    fact_amt: Column | None = None
    values: dict[str, Column] | None = None

    def body(self) -> Column:
        label = F.lit(self.label) if isinstance(self.label, str) else self.label
        fact = self.gross if self.fact_amt is None else self.fact_amt
        return F.struct(
            label.alias("type"), money(fact).alias("fact_amt"), money(self.gross).alias("gross"),
            money(self.inv_gross).alias("inv_amt"),
            *[value.alias(name) for name, value in (self.values or {}).items()],
        )


def post(rows: DataFrame, postings: Sequence[Posting], rates: Sequence[int]) -> DataFrame:
    """Rows of all postings, with the measures split; columns of ``rows`` a posting does not set
    are kept. All postings of one call set the same values."""
    set_here = {"type", "fact_amt", "gross", "inv_amt", *(postings[0].values or {})}
    kept = [c for c in rows.columns if c not in set_here]
    if len(postings) == 1:
        only = postings[0]
        booked = rows.filter(only.rule).select(*kept, only.body().alias("_p"))
    else:
        matched = F.array_compact(F.array(*[F.when(p.rule, p.body()) for p in postings]))
        any_rule = reduce(Column.__or__, [p.rule for p in postings])
        booked = rows.filter(any_rule).select(*kept, F.explode(matched).alias("_p"))
    return split(booked.select(*kept, "_p.*"), rates)


def split(rows: DataFrame, rates: Sequence[int]) -> DataFrame:
    """Add the VAT columns for ``gross`` and ``inv_amt``."""
    pct = F.col("vat")
    return rows.withColumns(
        {**vat_split(F.col("gross"), pct, rates), **invoice_split(F.col("inv_amt"), pct)}
    )


def summed(rows: DataFrame, keys: Sequence[str], measures: Sequence[str],
           *others: Column) -> DataFrame:
    """Group rounded rows: sums of rounded values, kept in the money type."""
    return rows.groupBy(*keys).agg(*[money(F.sum(m)).alias(m) for m in measures], *others)


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def shaped(rows: DataFrame, columns: Sequence[str], types: dict[str, str]) -> DataFrame:
    """Bring a branch to the column list and types of its book; text columns it lacks are NULL."""
    have = set(rows.columns)
    return rows.selectExpr(*[
        f"cast({c if c in have else 'null'} as {types.get(c, 'string')}) as {c}" for c in columns
    ])


def stored_schema(columns: Sequence[str], types: dict[str, str], *others: str) -> str:
    """DDL of a stored book or ledger, for reading it back with the types it was written with."""
    return ", ".join([*(f"{c} {types.get(c, 'string')}" for c in columns), *others])


__all__ = ["MONEY", "PERCENT", "Posting", "cents", "post", "shaped", "split", "stored_schema", "summed", "typed_null"]
