"""From a raw table to chart-ready data, on Spark."""

from chartloom.errors import (
    MissingPathError,
    TableReadError,
    UnreadableTableError,
    UnsupportedFormatError,
)
from chartloom.operators.price import clean_prices
from chartloom.operators.sample import exact_sample
from chartloom.plans.auto_clean import auto_clean
from chartloom.plans.chart_data import chart_data, chart_table, default_columns
from chartloom.plans.clean_sample import clean_and_sample, process_file
from chartloom.plans.insights import insights
from chartloom.sources.readers import read_table

__all__ = [
    "MissingPathError",
    "TableReadError",
    "UnreadableTableError",
    "UnsupportedFormatError",
    "auto_clean",
    "chart_data",
    "chart_table",
    "clean_and_sample",
    "clean_prices",
    "default_columns",
    "exact_sample",
    "insights",
    "process_file",
    "read_table",
]
