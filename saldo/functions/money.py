"""Money arithmetic on decimals: rounding, the VAT split, sign rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(19,4)"
RATES_BOOK = (20, 10)
RATES_BUFFER = (20, 18)


def money(value: Column) -> Column:
    return value.cast(MONEY)


def cents(value: Column) -> Column:
    """Two digits, half away from zero, kept in the money type."""
    return money(F.round(value, 2))


def local_amount(amount: Column, rate: Column) -> Column:
    """Amount at the booking rate, rounded to cents."""
    return cents(amount * rate)


def vat_f(amount: Column, pct: Column, mode: int) -> Column:
    """Part of a tax-inclusive amount: 1 = base without tax, 2 = the tax. NULL rate gives NULL."""
    if mode not in (1, 2):
        raise ValueError("mode is 1 (base) or 2 (tax)")
    pct = pct.cast("decimal(5,2)")
    return amount * (F.lit(100).cast("decimal(5,2)") if mode == 1 else pct) / (pct + 100)


def vat_split(gross: Column, pct: Column, rates: Sequence[int]) -> dict[str, Column]:
    """``base<r>`` and ``vat<r>`` for each rate, and ``base0``: the parts land in the columns of the
    account's own rate, all other columns are zero. Base and tax are rounded each on its own."""
    zero = F.lit(0).cast(MONEY)
    base, vat = cents(vat_f(gross, pct, 1)), cents(vat_f(gross, pct, 2))
    columns = {}
    for rate in rates:
        columns[f"base{rate}"] = F.when(pct == rate, base).otherwise(zero)
        columns[f"vat{rate}"] = F.when(pct == rate, vat).otherwise(zero)
    columns["base0"] = F.when(pct == 0, gross).otherwise(zero)
    return columns


def invoice_split(gross: Column, pct: Column) -> dict[str, Column]:
    """Base and tax of the original-currency amount, whatever the rate."""
    return {"inv_base": cents(vat_f(gross, pct, 1)), "inv_vat": cents(vat_f(gross, pct, 2))}


def measures(rates: Sequence[int]) -> list[str]:
    """Names of the additive columns, in output order."""
    parts = [f"{kind}{rate}" for rate in rates for kind in ("base", "vat")]
    return ["fact_amt", *parts, "base0", "inv_amt", "inv_base", "inv_vat"]


def signs_agree(left: Column, right: Column) -> Column:
    return F.signum(left) == F.signum(right)


def rounding_residual(amount: Column, rate: Column) -> Column:
    """What rounding to cents adds or takes, exact to the last digit of the product."""
    return F.round(amount * rate, 2) - amount * rate
