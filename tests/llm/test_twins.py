"""Queries that SQL has words for, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from saldo.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_twin(spark, name, folder):
    connection = duckdb.connect()
    for given in ("pages", "documents", "embeddings"):
        connection.sql(f"create view {given} as select * from '{folder}/{given}.parquet'")
    ours, theirs = QUERIES[name](spark, folder), connection.sql(ORACLE[name])
    assert ours.columns == theirs.columns
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, theirs.fetchall()))
