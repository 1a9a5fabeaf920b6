"""Uniqueness checks fail the job that joins the table, and padded remote keys still match."""

from __future__ import annotations

from collections import ChainMap

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saldo.operators.chains import chain_closure
from saldo.operators.guards import require_unique
from saldo.plans.book import SalesBook
from saldo.plans.buffer import TaxBuffer
from saldo.plans.scope import customers


def doubled(tables, name):
    return ChainMap({name: tables[name].unionByName(tables[name])}, tables)


@pytest.mark.parametrize("name, use", [
    ("organizations", lambda t: customers(t)),
    ("plan_schetov", lambda t: SalesBook(t).accruals()),
    ("organizations", lambda t: SalesBook(t).accruals()),
    ("plan_schetov", lambda t: TaxBuffer(t).accruals()),
    ("master_comp_scala", lambda t: TaxBuffer(t).accruals()),
    ("organizations", lambda t: TaxBuffer(t).accruals()),
])
def test_repeated_dimension_fails_the_joined_job(tables, name, use):
    with pytest.raises(PySparkException, match="not unique"):
        use(doubled(tables, name)).collect()


def test_check_survives_joins_and_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    for how in ("inner", "left", "left_semi"):
        with pytest.raises(PySparkException, match="not unique on k: 2"):
            facts.join(require_unique(df, ["k"]), "k", how).collect()
    with pytest.raises(PySparkException, match="not unique on k: 2"):
        facts.join(require_unique(df, ["k"]).filter("v is not null"), "k").collect()


def test_closure_has_no_cap_and_checks_its_edges(spark):
    edges = spark.range(3000).select(F.col("id").alias("old_card"), (F.col("id") + 1).alias("new_card"))
    got = chain_closure(edges)
    assert got.filter("cyclic").count() == 0 and got.agg(F.max("length")).first()[0] == 3000
    with pytest.raises(PySparkException, match="not unique"):
        chain_closure(edges.union(edges.limit(1))).collect()


def test_padded_remote_keys_match(tables):
    padded = ChainMap({
        name: tables[name].withColumn(key, F.concat(key, F.lit("  ")))
        for name, key in (("reversals", "invoice"), ("special_trans", "comp_scala"), ("inv_lib", "invoice"))
    }, tables)
    for branch in ("payments", "reversals", "special"):
        want = sorted(map(str, getattr(TaxBuffer(tables), branch)().collect()))
        assert sorted(map(str, getattr(TaxBuffer(padded), branch)().collect())) == want
