"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.text import column

# The spellings of a number that are accepted in text. Spark's own
# cast also takes "1d", "2f", "NaN" and hexadecimal floats, which are not numbers here.
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


# The spelling of a whole number.
WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"


def amount(text: Column) -> Column:
    """Text that Spark can cast to double, as a double; anything else is null."""
    return F.trim(text).try_cast("double")


def number(text: Column) -> Column:
    """Text in one of the accepted spellings, as a double; anything else is null."""
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def without_nan(value: Column) -> Column:
    """Null in place of NaN, so that a missing number has one form only."""
    return F.when(~F.isnan(value), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Apply :func:`without_nan` to every floating-point column of a table."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({name: without_nan(column(name)) for name in floats}) if floats else df


def two_decimals(value: Column) -> Column:
    """Thousands separators and two decimals, as text."""
    return F.format_number(value, 2)
