"""Text helpers: trimming, document keys, tax numbers, partition names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the check digits of a 10- and a 12-digit tax number.
WEIGHTS_10 = (2, 4, 10, 3, 5, 9, 4, 6, 8)
WEIGHTS_12_FIRST = (7, 2, 4, 10, 3, 5, 9, 4, 6, 8)
WEIGHTS_12_SECOND = (3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8)


def or_blank(value: Column, blank: str = "") -> Column:
    return F.coalesce(value, F.lit(blank))


def doc_key(prefix: str, org_code: Column, account: Column, day: Column) -> Column:
    """``prefix_org_account_month_year``, month without a leading zero; NULL if a part is NULL."""
    parts = [F.trim(org_code), F.trim(account), F.month(day).cast("string"),
             F.year(day).cast("string")]
    pieces: list[Column] = [F.lit(prefix)]
    for part in parts:
        pieces += [F.lit("_"), part]
    return F.concat(*pieces)


def _digit(number: Column, position: int) -> Column:
    return F.substring(number, position, 1).try_cast("int")


def _check_digit(number: Column, weights: tuple[int, ...]) -> Column:
    total = sum((_digit(number, i + 1) * w for i, w in enumerate(weights)), F.lit(0))
    return total % 11 % 10


def is_tax_number(number: Column) -> Column:
    """True for a 10- or 12-digit number whose check digits agree; never NULL."""
    ten = number.rlike("^[0-9]{10}$") & (_check_digit(number, WEIGHTS_10) == _digit(number, 10))
    twelve = (
        number.rlike("^[0-9]{12}$")
        & (_check_digit(number, WEIGHTS_12_FIRST) == _digit(number, 11))
        & (_check_digit(number, WEIGHTS_12_SECOND) == _digit(number, 12))
    )
    return F.coalesce(ten | twelve, F.lit(False))


def clean_tax_number(number: Column) -> Column:
    """The number if it is valid, else an empty text."""
    return F.when(is_tax_number(number), number).otherwise("")


def day_of_name(name: Column, prefix: str) -> Column:
    """Day in a ``<prefix>yyyymmdd`` name; NULL for a name of any other form."""
    digits = F.regexp_extract(name, r"(\d{8})$", 1)
    return F.when(name.rlike(rf"^{prefix}\d{{8}}$"), F.try_to_date(digits, "yyyyMMdd"))
