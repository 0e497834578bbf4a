"""High-level facts about a table, as rows ``(seq, kind, column, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.numbers import nan_to_null
from chartloom.operators.frequency import modes
from chartloom.operators.profile import missing_cell_total
from chartloom.operators.roles import numeric_columns, quick_fact_column, text_columns


def quick_fact(df: DataFrame) -> DataFrame:
    """Most frequent value of the first categorical column that is not a key.

    A column without any value gives a null fact; a table without such a column
    gives no row.
    """
    name = quick_fact_column(text_columns(df))
    if name is None:
        return df.sparkSession.createDataFrame([], "column string, value string")
    return modes(df, [name]).agg(F.max("value").alias("value")).select(
        F.lit(name).alias("column"), "value"
    )


def insights(df: DataFrame) -> DataFrame:
    """Shape, missing cells, number of columns per role, quick fact."""
    df = nan_to_null(df)
    facts = {
        "n_rows": F.count(F.lit(1)),
        "n_columns": F.lit(len(df.columns)),
        "missing_cells": missing_cell_total(df),
        "numeric_columns": F.lit(len(numeric_columns(df))),
        "categorical_columns": F.lit(len(text_columns(df))),
    }
    rows = [
        F.struct(
            F.lit(seq).alias("seq"),
            F.lit(kind).alias("kind"),
            F.lit(None).cast("string").alias("column"),
            value.cast("string").alias("value"),
        )
        for seq, (kind, value) in enumerate(facts.items())
    ]
    table = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    return table.unionByName(
        quick_fact(df).select(
            F.lit(len(facts)).alias("seq"), F.lit("quick_fact").alias("kind"), "column", "value"
        )
    )
