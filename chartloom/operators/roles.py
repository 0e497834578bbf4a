"""What a column is used for, decided from the schema alone (no Spark job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Name parts that steer the defaults.
MEASURE_WORDS = ("amount", "price")
KEY_WORD = "id"

NUMERIC, TEXT, DATE, BOOLEAN, OTHER = "numeric", "categorical", "date", "boolean", "other"


def role_of(data_type: T.DataType) -> str:
    """Role of one Spark type; nested and binary columns only pass through."""
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    return BOOLEAN if isinstance(data_type, T.BooleanType) else OTHER


def columns_with_role(df: DataFrame, role: str) -> list[str]:
    """Column names with the given role, in schema order."""
    return [field.name for field in df.schema if role_of(field.dataType) == role]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_with_role(df, NUMERIC)


def text_columns(df: DataFrame) -> list[str]:
    return columns_with_role(df, TEXT)


def date_columns(df: DataFrame) -> list[str]:
    return columns_with_role(df, DATE)


def trend_measure(numeric: list[str]) -> str | None:
    """Numeric column to follow over time: a named amount, else the first."""
    named = [n for n in numeric if any(word in n.lower() for word in MEASURE_WORDS)]
    return (named or numeric or [None])[0]


def quick_fact_column(categorical: list[str]) -> str | None:
    """First categorical column whose name does not look like a key."""
    plain = [name for name in categorical if KEY_WORD not in name.lower()]
    return plain[0] if plain else None
