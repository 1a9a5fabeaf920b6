"""The scalar functions as SQL functions of a session, for people who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from saldo.functions.text import WEIGHTS_10, WEIGHTS_12_FIRST, WEIGHTS_12_SECOND


def _check(number: str, weights: tuple[int, ...]) -> str:
    total = " + ".join(
        f"try_cast(substring({number}, {i}, 1) as int) * {w}" for i, w in enumerate(weights, 1)
    )
    return f"({total}) % 11 % 10"


def register_functions(spark: SparkSession) -> list[str]:
    """Create ``vat_f``, ``get_last_month_date`` and ``fn_is_inn``; bodies are SQL, inlined by
    Catalyst. (The write-off test needs a table, see ``saldo.plans.book.writeoff_flag``.)"""
    last = {n: f"try_cast(substring(s, {n}, 1) as int)" for n in (10, 11, 12)}
    bodies = {
        "vat_f(amount DECIMAL(19,4), pct DECIMAL(5,2), mode INT) RETURNS DECIMAL(34,13)":
            "amount * (CASE WHEN mode = 1 THEN CAST(100 AS DECIMAL(5,2)) ELSE pct END)"
            " / (pct + 100)",
        "get_last_month_date(d DATE) RETURNS DATE": "last_day(d)",
        "fn_is_inn(s STRING) RETURNS INT":
            "CASE WHEN s RLIKE '^[0-9]{10}$' AND "
            f"{_check('s', WEIGHTS_10)} = {last[10]} THEN 1 "
            f"WHEN s RLIKE '^[0-9]{{12}}$' AND {_check('s', WEIGHTS_12_FIRST)} = {last[11]} "
            f"AND {_check('s', WEIGHTS_12_SECOND)} = {last[12]} THEN 1 ELSE 0 END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in bodies]
