"""Batch job: clean the price columns, draw a sample, write it as one CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartloom.operators.price import clean_prices
from chartloom.operators.sample import SAMPLE_ROWS, exact_sample
from chartloom.sources.readers import read_table
from chartloom.sources.sinks import write_sample_csv


class EmptyResultError(Exception):
    """Nothing is left to sample after the cleaning."""


def clean_and_sample(
    df: DataFrame,
    n: int = SAMPLE_ROWS,
    seed: int = 0,
    key: str | None = None,
    unique_key: bool = False,
) -> DataFrame:
    """Clean the prices where the columns exist and draw an exact sample."""
    return exact_sample(clean_prices(df), n, seed, key, unique_key)


def process_file(
    spark: SparkSession,
    source: str,
    target: str,
    n: int = SAMPLE_ROWS,
    seed: int = 0,
    key: str | None = None,
    fmt: str | None = None,
    unique_key: bool = False,
) -> str:
    """Read, clean, sample and write one CSV file; returns its path."""
    cleaned = clean_prices(read_table(spark, source, fmt, typed=False))
    if cleaned.isEmpty():
        raise EmptyResultError(f"{source}: no row is left after cleaning")
    return write_sample_csv(exact_sample(cleaned, n, seed, key, unique_key), target)
