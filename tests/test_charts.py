"""Chart data: limits, properties and edge cases."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from chartloom.operators import charts
from chartloom.plans.chart_data import chart_data, chart_table, choose_columns, colour_candidates
from workload.inputs import derived, table


def words(spark, kinds, extra=()):
    values = [(f"v{i:02d}",) for i in range(kinds) for _ in range(kinds - i)]
    return spark.createDataFrame(values + [(x,) for x in extra], "t string")


@pytest.mark.parametrize("n", [10, 15])
def test_remainder_appears_beyond_the_limit_only(spark, n):
    at_limit = charts.top_n_with_other(words(spark, n), "t", n).collect()
    assert len(at_limit) == n and not any(r["is_other"] for r in at_limit)
    rows = words(spark, n + 1, [None])
    beyond = charts.top_n_with_other(rows, "t", n).collect()
    assert len(beyond) == n + 1
    assert [(r["value"], r["n"]) for r in beyond if r["is_other"]] == [("Other", 1)]
    assert sum(r["n"] for r in beyond) == rows.where("t is not null").count()


def test_a_real_other_keeps_its_row(spark):
    rows = charts.top_n_with_other(words(spark, 12, ["Other"] * 50), "t", 10).collect()
    assert {(r["is_other"], r["n"]) for r in rows if r["value"] == "Other"} == {(False, 50), (True, 6)}


def test_shares_sum_to_one(spark):
    rows = charts.category_share(words(spark, 14, [None] * 9), "t").collect()
    assert sum(r["share"] for r in rows) == pytest.approx(1.0)


def test_histogram_counts_every_value(spark):
    values = [1.0, 2.0, 2.5, 10.0, None, float("nan"), float("inf"), float("-inf")]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    bins = charts.histogram(rows, "x", 4).collect()
    assert sum(r["n"] for r in bins) == 6
    assert [(r["bin"], r["n"]) for r in bins] == [(0, 4), (3, 2)]


def test_histogram_of_a_constant(spark):
    rows = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r["bin"], r["n"]) for r in charts.histogram(rows, "x").collect()] == [(0, 2)]


def test_totals_of_empty_and_huge_columns(spark):
    rows = spark.createDataFrame([(None, 2**62), (None, 2**62), (None, 2**62)], "a double, b bigint")
    totals = {r["column"]: r["total"] for r in charts.kpi_totals(rows).collect()}
    assert totals == {"a": 0.0, "b": float(3 * 2**62)}


def test_only_four_totals_by_default(spark):
    rows = spark.range(1).selectExpr(*[f"id as c{i}" for i in range(6)])
    assert [r["column"] for r in charts.kpi_totals(rows).orderBy("seq").collect()] == ["c0", "c1", "c2", "c3"]


def test_correlation_edges(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, None, 5.0, None), (4.0, 8.0, 5.0, None)],
        "a double, b double, c double, d double",
    )
    cells = {(r["col_x"], r["col_y"]): (r["r"], r["n"]) for r in charts.correlation_matrix(rows).collect()}
    assert len(cells) == 16
    assert cells["a", "b"][0] == pytest.approx(1.0) and cells["a", "b"][1] == 3
    assert cells["b", "a"] == cells["a", "b"]
    assert cells["a", "a"] == (1.0, 4)
    assert cells["c", "c"] == (None, 4) and cells["a", "c"] == (None, 4)
    assert cells["a", "d"] == (None, 1)


def test_wide_correlation_against_plain_sums(spark):
    rng = np.random.default_rng(1)
    values = 1e9 + rng.normal(size=(300, 40)).cumsum(axis=1)
    values[rng.random(values.shape) < 0.2] = np.nan
    frame = pd.DataFrame(values, columns=[f"v{i}" for i in range(40)])
    found = charts.correlation_matrix(spark.createDataFrame(frame).repartition(3)).collect()
    want = frame.corr()
    assert len(found) == 1600
    assert all(r["r"] == pytest.approx(want.loc[r["col_x"], r["col_y"]], abs=1e-6) for r in found)


@pytest.mark.parametrize(
    "days, grain",
    [(0, "day"), (7, "day"), (8, "week"), (90, "week"), (91, "month"), (730, "month"), (731, "year")],
)
def test_automatic_grain(spark, days, grain):
    first = dt.datetime(2021, 3, 1)
    rows = spark.createDataFrame(
        [(first, 1.0), (first + dt.timedelta(days=days), 3.0), (None, 9.0)], "t timestamp_ntz, x double"
    )
    found = charts.trend_auto(rows, "t", "x").collect()
    assert {r["grain"] for r in found} == {grain}
    assert sum(r["mean"] for r in found) == (2.0 if days == 0 else 4.0)


def test_a_period_without_measure_stays(spark):
    rows = spark.sql("select date'2024-01-01' as d, cast(null as double) as x")
    assert [tuple(r) for r in charts.trend(rows, "d", "x", "day").collect()] == [(dt.date(2024, 1, 1), None)]


def test_grid_counts_every_complete_row(spark, small):
    lineitem = table(spark, small, "lineitem")
    cells = charts.scatter_grid(lineitem, "l_quantity", "l_tax", "l_returnflag", 10)
    assert cells.groupBy().sum("n").first()[0] == lineitem.count()


@pytest.mark.parametrize("kinds, bar, share", [(1, "b", "b"), (2, "a", "a"), (9, "a", "a"), (10, "a", "b"), (19, "a", "b"), (20, "b", "b")])
def test_default_columns_at_the_limits(spark, kinds, bar, share):
    """Column a has the given number of values, column b always five."""
    rows = spark.range(400).selectExpr(f"concat('a', id % {kinds}) as a", "concat('b', id % 5) as b")
    chosen = choose_columns(rows)
    assert (chosen.bar, chosen.share) == (bar, share)


def test_first_categorical_is_the_last_resort(spark):
    rows = spark.range(400).selectExpr("concat('a', id) as a", "concat('b', id % 50) as b")
    assert choose_columns(rows).bar == "a" and colour_candidates(rows) == []


def test_staged_and_unstaged_charts_agree(spark, small):
    mixed = derived(spark, small, "MIXED")
    tables = [
        {tuple(r)[:3]: r["value"] for r in chart_table(chart_data(mixed, stage=stage)).collect()}
        for stage in (True, False)
    ]
    assert tables[0] == pytest.approx(tables[1])


def test_text_only_table_gets_bar_and_share(spark):
    assert set(chart_data(words(spark, 3))) == {"bar", "share"}


def test_choices_can_be_replaced(spark, small):
    built = chart_data(table(spark, small, "orders"), trend="o_custkey", share="o_orderpriority")
    assert set(built) == {"kpis", "trend", "share", "histogram", "correlation", "scatter_grid"}
    assert built["share"].count() == 5
    with_points = chart_data(table(spark, small, "orders"), scatter_rows=70)
    assert with_points["scatter"].count() == 70
