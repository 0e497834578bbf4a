"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, connection, small, name):
    assert differences(spark, connection, QUERIES[name], ORACLES[name], small) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == ["chart", "series", "label", "value", "n", "low", "high", "colour"]
    assert {r["chart"] for r in result.select("chart").distinct().collect()} == {
        "kpis", "trend", "share", "histogram", "correlation", "scatter_grid",
    }
