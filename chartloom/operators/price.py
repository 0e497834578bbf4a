"""Row-wise cleaning of the two price columns and the rating.

Only row expressions are used, so the same function serves batch and streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from chartloom.functions.numbers import amount
from chartloom.functions.text import column, drop_marks

# The columns whose joint presence switches the cleaning on.
PRICE_COLUMNS = ("actual_price", "selling_price")
RATING_COLUMN = "average_rating"
EXPECTED_COLUMNS = (*PRICE_COLUMNS, RATING_COLUMN)


def missing_expected_columns(df: DataFrame) -> list[str]:
    """Expected columns that the table lacks, in name order."""
    return sorted(name for name in EXPECTED_COLUMNS if name not in df.columns)


def _as_amount(df: DataFrame, name: str) -> Column:
    value = column(name)
    if isinstance(df.schema[name].dataType, T.NumericType):
        return value.cast("double")
    text = value.cast("string")
    return amount(drop_marks(text) if name in PRICE_COLUMNS else text)


def clean_prices(df: DataFrame) -> DataFrame:
    """Turn prices and rating into doubles and drop rows where one is not a number.

    A table that lacks any of the three columns passes through unchanged.
    """
    if missing_expected_columns(df):
        return df
    typed = df.withColumns({name: _as_amount(df, name) for name in EXPECTED_COLUMNS})
    return typed.na.drop(subset=list(EXPECTED_COLUMNS))
