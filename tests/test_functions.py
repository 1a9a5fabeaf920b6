"""Column functions against plain Python arithmetic."""

from __future__ import annotations

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldo.functions import dates, money, register, text

CENT = Decimal("0.01")


def test_vat_split_of_many_amounts(spark):
    amounts = [Decimal(n) / 10000 for n in (*range(-30000, 30000, 37), 26750, -26650, 9 * 10**15)]
    df = spark.createDataFrame([(a, p) for a in amounts for p in (0, 10, 18, 20)],
                               "gross decimal(19,4), pct int")
    split = money.vat_split(F.col("gross"), F.col("pct"), (20, 18))
    got = df.select("gross", "pct", *[c.alias(n) for n, c in split.items()]).collect()
    for row in got:
        for rate in (20, 18):
            mine = row["pct"] == rate
            base = (row["gross"] * 100 / (100 + rate)).quantize(CENT, ROUND_HALF_UP) if mine else 0
            vat = (row["gross"] * rate / (100 + rate)).quantize(CENT, ROUND_HALF_UP) if mine else 0
            assert row[f"base{rate}"] == base and row[f"vat{rate}"] == vat
        assert row["base0"] == (row["gross"] if row["pct"] == 0 else 0)


def test_unknown_rate(spark):
    df = spark.range(1).select(F.lit(12).cast("decimal(19,4)").alias("g"), F.lit(None).cast("int").alias("p"))
    row = df.select(money.vat_f(F.col("g"), F.col("p"), 1).alias("b"),
                    money.vat_split(F.col("g"), F.col("p"), (20,))["base20"].alias("s")).first()
    assert row["b"] is None and row["s"] == 0
    with pytest.raises(ValueError):
        money.vat_f(F.col("g"), F.col("p"), 3)


def digit(number: str, weights) -> int:
    return sum(int(d) * w for d, w in zip(number, weights)) % 11 % 10


def valid(number: str | None) -> bool:
    if number is None or not number.isascii() or not number.isdigit():
        return False
    if len(number) == 10:
        return digit(number, text.WEIGHTS_10) == int(number[9])
    if len(number) == 12:
        return (digit(number, text.WEIGHTS_12_FIRST) == int(number[10])
                and digit(number, text.WEIGHTS_12_SECOND) == int(number[11]))
    return False


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text("0123456789", min_size=9, max_size=13),
                          st.text("0123456789x ", max_size=12)), min_size=200, max_size=300))
def test_tax_numbers(spark, numbers):
    numbers = [*numbers, "7707083893", "500100732259"]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    got = df.select("n", text.clean_tax_number(F.col("n")).alias("c")).collect()
    assert [r["c"] for r in got] == [n if valid(n) else "" for n in numbers]
    assert got[-1]["c"] and got[-2]["c"]


def test_sql_functions(spark):
    assert register.register_functions(spark) == ["vat_f", "get_last_month_date", "fn_is_inn"]
    row = spark.sql(
        "select round(vat_f(118.00, 18, 1), 2) b, round(vat_f(118.00, 18, 2), 2) v, "
        "get_last_month_date(date '2020-02-10') d, fn_is_inn('7707083893') i, fn_is_inn('1') j, "
        "fn_is_inn(null) k, fn_is_inn('500100732259') l"
    ).first()
    assert tuple(row) == (Decimal("100.00"), Decimal("18.00"), date(2020, 2, 29), 1, 0, 0, 1)


def test_document_key(spark):
    day = F.lit(date(2008, 1, 5))
    row = spark.range(1).select(
        text.doc_key("RG_", F.lit(" 77 "), F.lit("104"), day).alias("a"),
        text.doc_key("Act", F.lit(None).cast("string"), F.lit("104"), day).alias("b"),
    ).first()
    assert tuple(row) == ("RG__77_104_1_2008", None)


def test_periods():
    assert dates.Period(2008, 12).after == date(2009, 1, 1)
    assert dates.Period(2008).first == date(2008, 1, 1) and dates.Period(2008).after == date(2009, 1, 1)


def test_partition_names(spark):
    names = ["proc_20240131", "proc_2024013", "proc_20249999", "other_20240131", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(text.day_of_name(F.col("n"), "proc_")).collect()]
    assert got == [date(2024, 1, 31), None, None, None, None]
