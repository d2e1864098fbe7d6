"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert {query.__name__ for query in entry.QUERIES} <= set(SQL)


@pytest.mark.parametrize("name", [query.__name__ for query in entry.QUERIES])
def test_query(spark, duck, name):
    rows = entry.queries()[name](spark, FOLDER).toPandas()
    assert len(rows) > 0 or name in ("q12_anomalies", "q13_anomaly_envelope", "q23_report_fanout", "q37_pending_anomalies")
    assert oracle.compare(rows, duck.sql(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", ["q12_anomalies", "q13_anomaly_envelope", "q23_report_fanout"])
def test_anomalies_of_a_larger_table(spark, name):
    """The smallest table may hold none."""
    folder = "/root/testdata/sf0.01"
    rows = entry.queries()[name](spark, folder).toPandas()
    assert len(rows) > 0 and rows.isna().any(axis=None)
    assert oracle.compare(rows, oracle.connect(folder).sql(SQL[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
