"""Filling gaps: median for numbers, mode for text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.text import column
from chartloom.operators.frequency import modes
from chartloom.operators.median import as_double, exact_medians
from chartloom.operators.roles import numeric_columns, text_columns


def columns_with_gaps(df: DataFrame, names: list[str]) -> dict[str, int]:
    """Null (or NaN) count of the columns that have any."""
    if not names:
        return {}
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    row = df.agg(
        *[
            F.count_if((as_double(n) if n in floats else column(n)).isNull()).alias(f"n{i}")
            for i, n in enumerate(names)
        ]
    ).first()
    return {name: row[f"n{i}"] for i, name in enumerate(names) if row[f"n{i}"]}


def mode_values(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Mode of each text column that has a value; at most one row per column."""
    return {r["column"]: r["value"] for r in modes(df, names).collect()} if names else {}


def filled_number(name: str, median: float, kind: T.DataType | None = None, long: bool = False) -> Column:
    """The column with gaps replaced by the median, as double unless that would lose digits.

    ``long`` whole numbers (``kind``) keep their type if the median is whole, and become
    decimals if it is not.
    """
    if isinstance(kind, T.IntegralType) and long:
        kept = "bigint" if float(median).is_integer() else "decimal(21,1)"
        return F.coalesce(column(name).cast(kept), F.lit(repr(median)).cast("decimal(21,1)").cast(kept))
    return F.coalesce(as_double(name), F.lit(float(median)))


def filled_text(name: str, mode: str) -> Column:
    return F.coalesce(column(name), F.lit(mode))


def impute_median(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill gaps in numeric columns; a column without any value stays as it is."""
    names = numeric_columns(df) if columns is None else columns
    gaps = list(columns_with_gaps(df, names))
    medians = {n: m for n, m in exact_medians(df, gaps).items() if m is not None}
    return df.withColumns({n: filled_number(n, m) for n, m in medians.items()}) if medians else df


def impute_mode(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill gaps in text columns; a column without any value stays as it is."""
    names = text_columns(df) if columns is None else columns
    filled = mode_values(df, list(columns_with_gaps(df, names)))
    return df.withColumns({n: filled_text(n, v) for n, v in filled.items()}) if filled else df
