"""Every query of the package: against its SQL twin, and its columns."""

from __future__ import annotations

import pytest
from compare import connect, differences

from chartloom.llm.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, connection, small, name):
    assert differences(spark, connection, QUERIES[name], ORACLES[name], small) is None


def test_queries_without_sql_have_tests_of_their_own():
    assert set(QUERIES) - set(ORACLES) == {
        "op3_sharding", "op4_toxicity", "op6_lm_scoring", "op7_html_text",
        "op11_suffix_dedup", "op12_word_periods", "op13_spelling",
    }
