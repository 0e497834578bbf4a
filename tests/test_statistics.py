"""Profiles, medians, modes, distinct counts and filling against brute force."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chartloom.operators import frequency, impute, median, profile
from chartloom.operators.charts import correlation_matrix
from chartloom.operators.frequency import modes
from chartloom.plans.auto_clean import auto_clean, convert_text
from chartloom.plans.chart_data import chart_data
from chartloom.plans.insights import insights, quick_fact


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("size", [1, 2, 999, 1000])
def test_narrowing_gives_the_exact_median(spark, seed, size):
    draw = random.Random(seed)
    values = [draw.choice([draw.gauss(0, 1e6), 7.0, draw.randint(-3, 3)]) * 1.0 for _ in range(size)]
    found = median.exact_medians(doubles(spark, values), ["x"], accuracy=5)
    assert found == {"x": statistics.median(values)}


@pytest.mark.parametrize(
    "values",
    [
        [5.0] * 400 + [1.0] * 399 + [9.0],
        [5.0] * 500 + [6.0] * 500,
        [1.0] * 300 + [float(i) for i in range(2, 702)],
        [float("-inf")] * 100 + [float(i) for i in range(101)] + [float("inf")] * 100,
        [3.0] * 1000,
    ],
)
def test_narrowing_with_hot_values(spark, values):
    found = median.exact_medians(doubles(spark, values), ["x"], accuracy=5)
    assert found == {"x": statistics.median(values)}


def test_median_ignores_gaps_and_handles_several_columns(spark):
    rows = spark.createDataFrame(
        [(1, 2.0, None), (2, float("nan"), None), (4, 8.0, None)], "a int, b double, c double"
    )
    assert median.exact_medians(rows) == {"a": 2.0, "b": 5.0, "c": None}
    approximate = {r["column"]: r["median"] for r in median.approximate_medians(rows).collect()}
    assert approximate["a"] == 2.0


def test_mode_takes_the_smallest_on_a_tie(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "t string")
    assert [tuple(r) for r in frequency.modes(rows).collect()] == [("t", "a", 2)]


@pytest.mark.parametrize("size, inside", [(1, True), (9, True), (19, True), (20, False), (500, False)])
def test_low_cardinality_is_exact_at_the_limit(spark, size, inside):
    rows = spark.createDataFrame([(f"v{i % size}",) for i in range(1000)], "t string")
    assert frequency.low_cardinality(rows, ["t"], 20) == ({"t": size} if inside else {})


def test_distinct_counts_of_an_empty_column(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "b")], "t string, u string")
    assert {r[0]: r[1] for r in frequency.distinct_counts(rows).collect()} == {"t": 0, "u": 2}


def test_text_becomes_numeric_above_half_only(spark):
    rows = spark.createDataFrame(
        [("1", "1", None), ("2", "2", None), ("x", "$3", None), ("y", "y", None)],
        "half string, more string, none string",
    )
    verdict = {r["column"]: r["becomes_numeric"] for r in profile.text_profile(rows).collect()}
    assert verdict == {"half": False, "more": True, "none": False}


def test_text_becomes_date_above_seventy_percent_only(spark):
    exact = [("2024-01-01",)] * 7 + [("no",)] * 3
    assert profile.find_date_column(spark.createDataFrame(exact, "t string")) is None
    more = [("01/02/2024",)] * 8 + [("no",)] * 2
    found = profile.find_date_column(spark.createDataFrame(more, "t string"))
    assert found == profile.DateColumn("t", "slashed")


def test_native_dates_come_first(spark):
    rows = spark.sql("select '2024-01-01' as t, date'2024-01-02' as d")
    assert profile.find_date_column(rows) == profile.DateColumn("d")


def test_cleaning_leaves_gaps_only_in_empty_columns(spark):
    rows = spark.createDataFrame(
        [(1, " a ", "$1,000", None, None), (None, "a", "20", None, None), (4, None, "bad", None, 2.0)],
        "n int, t string, amount string, none string, d double",
    )
    cleaned, report = auto_clean(rows)
    assert [tuple(r) for r in cleaned.orderBy("n").collect()] == [
        (1.0, "a", 1000.0, None, 2.0), (2.5, "a", 20.0, None, 2.0), (4.0, "a", 510.0, None, 2.0),
    ]
    steps = [(r["action"], r["column"], r["n_changed"]) for r in report.orderBy("seq").collect()]
    assert steps == [
        ("trimmed", "t", 1), ("converted", "amount", 2), ("filled_median", "n", 1),
        ("filled_median", "amount", 1), ("filled_median", "d", 2), ("filled_mode", "t", 1),
    ]


def test_marks_stay_in_text_unless_asked(spark):
    rows = spark.createDataFrame([("Hello, world",), ("x",)], "t string")
    assert {r[0] for r in convert_text(rows).collect()} == {"Hello, world", "x"}
    assert {r[0] for r in convert_text(rows, strip_all=True).collect()} == {"Hello world", "x"}


def test_nothing_to_do_is_reported(spark):
    _, report = auto_clean(spark.createDataFrame([(1, "a")], "n int, t string"))
    assert [r["action"] for r in report.orderBy("seq").collect()] == [
        "nothing_to_convert", "nothing_to_fill",
    ]


def test_empty_table(spark):
    rows = spark.createDataFrame([], "n int, t string")
    cleaned, _ = auto_clean(rows)
    assert cleaned.collect() == []
    values = {r["kind"]: r["value"] for r in insights(rows).collect()}
    assert values["n_rows"] == "0" and values["missing_cells"] == "0"
    assert values["quick_fact"] is None


def test_filling_keeps_other_columns(spark):
    rows = spark.createDataFrame([(1, None), (None, "b"), (3, "b")], "n bigint, t string")
    assert impute.impute_median(rows).orderBy("n").first()["n"] == 1.0
    assert [r["t"] for r in impute.impute_mode(rows).collect()] == ["b", "b", "b"]


def test_quick_fact_skips_key_like_names(spark):
    rows = spark.createDataFrame([("a", "b", "z"), ("a", "c", "z")], "uid string, provider string, kind string")
    assert [tuple(r) for r in quick_fact(rows).collect()] == [("kind", "z")]
    assert quick_fact(rows.select("uid")).collect() == []
    nothing = spark.createDataFrame([(None,)], "kind string")
    assert [tuple(r) for r in quick_fact(nothing).collect()] == [("kind", None)]


def test_awkward_column_names(spark):
    rows = spark.createDataFrame([("1", None), ("2", 3.0)], "`a.b c` string, `x``y` double")
    cleaned, _ = auto_clean(rows)
    assert sorted(tuple(r) for r in cleaned.collect()) == [(1.0, 3.0), (2.0, 3.0)]


def test_correlation_with_far_values_and_gaps(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=1_001)
    frame = pd.DataFrame({"x": x, "y": x + rng.normal(size=1_001) / 10, "z": 1e9 + x, "k": 5.0, "w": rng.normal(size=1_001)})
    frame.loc[0, ["x", "y"]] = 1e12, None
    frame.loc[3:400, "w"] = None
    frame.loc[3:700, "z"] = frame.loc[3:700, "z"] + 1e13 * frame["w"][3:700].isna()
    rows = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in frame.to_numpy()], "x double, y double, z double, k double, w double")
    found = {(r["col_x"], r["col_y"]): r["r"] for r in correlation_matrix(rows.repartition(7)).collect()}
    for a in frame:
        for b in frame:
            both = frame[[a, b]].dropna().to_numpy(dtype=np.longdouble)
            off = both - both.mean(axis=0)
            spread = (off * off).sum(axis=0)
            wanted = float((off[:, 0] * off[:, 1]).sum() / np.sqrt(spread[0] * spread[1])) if (spread > 1e-9).all() else None
            assert found[a, b] == (wanted if wanted is None else pytest.approx(wanted, abs=1e-6)), (a, b)
    empty = correlation_matrix(rows.limit(0)).collect()
    assert len(empty) == 25 and all(r["r"] is None and r["n"] == 0 for r in empty)


def test_modes_beyond_what_a_summary_holds(spark):
    """Unique long texts, long texts that tie, one value among many, and few values."""
    n = 6_000
    rows = spark.range(n).select(
        F.concat(F.repeat(F.lit("x"), 100), F.lpad(F.col("id").cast("string"), 6, "0")).alias("unique"),
        F.concat(F.repeat(F.lit("x"), 100), (F.col("id") % (n // 2)).cast("string")).alias("pairs"),
        F.when(F.col("id") % 50 == 0, "often").otherwise(F.col("id").cast("string")).alias("one"),
        (F.col("id") % 3).cast("string").alias("few"),
        F.lit(None).cast("string").alias("none"),
    )
    found = {r["column"]: (r["value"], r["n"]) for r in modes(rows.repartition(5)).collect()}
    assert found == {
        "unique": ("x" * 100 + "000000", 1), "pairs": ("x" * 100 + "0", 2), "one": ("often", n // 50), "few": ("0", n // 3)
    }


@pytest.mark.parametrize("clean", [True, False])
def test_charts_scan_the_raw_table_twice(spark, clean):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(400).selectExpr(
        "id", "case when id % 7 = 0 then null else concat(' ', id % 3) end as few", "concat('$', id * 1.5) as amount",
        "case when id % 9 > 0 then cast(date_add(date'2020-01-01', cast(id as int)) as string) end as day",
        "case when id % 5 > 0 then cast(id as double) end as gaps",
    )
    watched = rows.mapInPandas(counted, rows.schema)
    for chart in chart_data(watched, clean=clean).values():
        chart.collect()
    assert seen.value <= 3 * 400
