"""Periods, month ends and the date formats of the reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbered date styles and their patterns.
DATE_STYLES = {101: "MM/dd/yyyy", 103: "dd/MM/yyyy", 104: "dd.MM.yyyy", 108: "HH:mm:ss"}


@dataclass(frozen=True)
class Period:
    """One calendar month, or a whole year when no month is given."""

    year: int
    month: int | None = None

    @property
    def first(self) -> date:
        return date(self.year, self.month or 1, 1)

    @property
    def after(self) -> date:
        """The first day that no longer belongs to the period."""
        if self.month is None or self.month == 12:
            return date(self.year + 1, 1, 1)
        return date(self.year, self.month + 1, 1)

    def holds(self, day: Column) -> Column:
        """Half-open range on the bare column, so that the scan can use it."""
        return (day >= F.lit(self.first)) & (day < F.lit(self.after))


def in_period(period: Period | None, day: Column) -> Column:
    """All days when no period is asked for; NULL dates belong to no period."""
    return F.lit(True) if period is None else period.holds(day)


def month_end(day: Column) -> Column:
    return F.last_day(day)


def styled(value: Column, style: int) -> Column:
    return F.date_format(value, DATE_STYLES[style])
