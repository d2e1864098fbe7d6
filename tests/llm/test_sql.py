"""Queries with SQL against DuckDB, over whole tables."""

from __future__ import annotations

import os

import oracle
import pytest

from tickloom.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    rows = queries.queries()[name](spark, FOLDER).toPandas().convert_dtypes()
    assert len(rows) > 0
    assert oracle.compare(rows, oracle.connect(FOLDER).sql(SQL[name]).df().convert_dtypes()) == ""
