"""Text, number and date expressions on literal values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.functions import dates, numbers, text


def column_of(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_white_space_list_is_the_full_one():
    assert set(text.WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_trim_removes_all_white_space_at_the_ends_only(spark):
    values = ["\t a b \n", " x ", "  ", "", None, "in\tside", "\x1fy\x85"]
    assert column_of(spark, values, text.trim_text) == [
        v if v is None else v.strip() for v in values
    ]


def test_drop_marks(spark):
    assert column_of(spark, ["$1,234", "₹5", "a,b$", "€3"], text.drop_marks) == [
        "1234", "5", "ab", "€3",
    ]


def test_number_accepts_plain_spellings_only(spark):
    accepted = {
        "1": 1.0, " 2 ": 2.0, "\t3\n": 3.0, "1e5": 1e5, "+4": 4.0, "-5": -5.0, ".5": 0.5,
        "5.": 5.0, "inf": float("inf"), "-Infinity": float("-inf"),
    }
    refused = ["1d", "2f", "NaN", "", "0x10", "1_000", "1,000", "$3", "true", "--", "٣", None]
    assert column_of(spark, list(accepted), numbers.number) == list(accepted.values())
    assert column_of(spark, refused, numbers.number) == [None] * len(refused)


def test_amount_follows_spark_casts_without_raising(spark):
    assert column_of(spark, [" 1.5 ", "N/A", "", None], numbers.amount) == [1.5, None, None, None]


def test_nan_becomes_null(spark):
    rows = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int")
    assert [tuple(r) for r in numbers.nan_to_null(rows).orderBy("b").collect()] == [(None, 1), (2.0, 2)]


DATE_TEXT = [
    "2017-01-05", "2017-01-05 10:11:12", "01/05/2017", "Jan 5, 2017", "20170105", "2017", "12",
    "abc", "2017-13-01", "10:30", None,
]


@pytest.mark.parametrize(
    "layout, index", [("iso_date", 0), ("iso_timestamp", 1), ("slashed", 2), ("month_name", 3), ("compact", 4)]
)
def test_each_layout_reads_its_own_text_only(spark, layout, index):
    found = column_of(spark, DATE_TEXT, lambda c: dates.parse_date(c, layout))
    moment = dt.datetime(2017, 1, 5, 10, 11, 12) if index == 1 else dt.datetime(2017, 1, 5)
    assert found == [moment if i == index else None for i in range(len(DATE_TEXT))]


@pytest.mark.parametrize(
    "days, grain",
    [(0, "day"), (7, "day"), (8, "week"), (90, "week"), (91, "month"), (730, "month"), (731, "year")],
)
def test_grain_limits(spark, days, grain):
    assert spark.range(1).select(dates.grain_for(F.lit(days)).alias("g")).first()["g"] == grain


def test_weeks_start_on_monday(spark):
    rows = spark.sql(
        "select timestamp_ntz'2024-01-07 23:00:00' as t union all select timestamp_ntz'2024-01-08 00:00:00'"
    )
    weeks = {r[0] for r in rows.select(dates.period_start(F.col("t"), "week")).collect()}
    assert weeks == {dt.date(2024, 1, 1), dt.date(2024, 1, 8)}


def test_unknown_grain_is_refused(spark):
    with pytest.raises(ValueError):
        dates.period_start(F.col("t"), "hour")
