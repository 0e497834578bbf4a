"""Column profiles: one scan, and a shuffle of one row per task and column at most.

Text columns are turned into long form ``(column, value)`` before they are measured, so
that the tests of a value are written once, whatever the number of columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.dates import LAYOUTS, fitting_layouts, parse_date
from chartloom.functions.numbers import NUMBER_TEXT, WHOLE_TEXT, without_nan
from chartloom.functions.text import column, drop_marks, trim_text
from chartloom.operators.roles import DATE, NUMERIC, date_columns, role_of, text_columns

# A text column is retyped when more than this share of all rows parses.
NUMERIC_SHARE = 0.5
DATE_SHARE = 0.7
EXACT_DIGITS = 15  # that a double surely holds


def record_array(records: list[dict[str, Column]]) -> Column:
    """Array of one struct per record, made of aggregate expressions."""
    return F.array(
        *[F.struct(*[expr.alias(name) for name, expr in record.items()]) for record in records]
    )


def rows_from_aggregates(df: DataFrame, records: list[dict[str, Column]], schema: str) -> DataFrame:
    """Evaluate every record's aggregates in one pass and return one row per record."""
    if not records:
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(record_array(records).alias("records")).select(F.inline("records"))


def dataset_shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def gap_places(df: DataFrame) -> Column:
    """Places of the row's null or NaN cells, in one array: as wide as the table, not as deep."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    flags = [
        F.when((without_nan(column(name)) if name in floats else column(name)).isNull(), seq)
        for seq, name in enumerate(df.columns)
    ]
    return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<int>")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls (and NaN) per column: one row for each gap is counted, by its column's place."""
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "seq int, column string")
    gaps = df.select(F.explode(gap_places(df)).alias("seq")).groupBy("seq").agg(F.count(F.lit(1)).alias("n_null"))
    return names.join(gaps, "seq", "left").select("seq", "column", F.coalesce("n_null", F.lit(0)).alias("n_null"))


def missing_cell_total(df: DataFrame) -> Column:
    """Aggregate expression: null and NaN cells over all columns."""
    return F.coalesce(F.sum(F.size(gap_places(df)).cast("bigint")), F.lit(0).cast("bigint"))


def missing_cells(df: DataFrame) -> DataFrame:
    """Null cells over the whole table."""
    return df.agg(missing_cell_total(df).alias("missing_cells"))


def long_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every cell of the columns as ``(seq, column, value, text, bare, layouts)``.

    ``text`` is the trimmed value, ``bare`` the same without amount marks, ``layouts``
    the bits of all date layouts that it fits. What a caller leaves out is not computed.
    """
    place = F.array_position(F.array(*[F.lit(name) for name in columns]), F.col("column"))
    text = trim_text(F.col("value"))
    return (
        df.select(*[column(name) for name in columns])
        .unpivot([], [column(name) for name in columns], "column", "value")
        .select((place - 1).cast("int").alias("seq"), "column", "value", text.alias("text"))
        .withColumns({"bare": drop_marks(F.col("text")), "layouts": fitting_layouts(F.col("text"))})
    )


def number_facts(is_number: Column | None = None) -> dict[str, Column]:
    """Aggregates over :func:`long_text` about gaps, marks and numbers.

    Removing marks from a value without any changes nothing, so the share is
    always taken on the mark-free text and one pass is enough.
    """
    text, bare, rows = F.col("text"), F.col("bare"), F.count(F.lit(1))
    n_numeric = F.count_if(bare.rlike(NUMBER_TEXT) if is_number is None else is_number)
    whole = bare.rlike(WHOLE_TEXT)
    return {
        "n_rows": rows,
        "n_null": F.count_if(text.isNull()),
        "n_trimmed": F.count_if(text != F.col("value")),
        "has_marks": F.coalesce(F.bool_or(bare != text), F.lit(False)),
        "n_numeric": n_numeric,
        "numeric_share": n_numeric / rows,
        "becomes_numeric": n_numeric / rows > NUMERIC_SHARE,
        "n_whole": F.count_if(whole & bare.try_cast("bigint").isNotNull()),
        "n_long": F.count_if(whole & (F.length(F.regexp_replace(bare, r"^\s*[+-]?0*|\s+$", "")) > EXACT_DIGITS)),
    }


def date_facts() -> dict[str, Column]:
    """Aggregates over :func:`long_text` about dates.

    A value counts for every layout that it fits, so the layout with most hits is the one
    that no value contradicts, if there is one: a day above twelve settles what comes first.
    Ties go to the layout listed first.
    """
    rows = F.count(F.lit(1))
    best = F.greatest(
        *[
            F.struct(
                F.count_if(F.col("layouts").bitwiseAND(1 << rank) != 0).alias("hits"),
                F.lit(-rank).alias("rank"),
                F.lit(layout).alias("layout"),
            )
            for rank, layout in enumerate(LAYOUTS)
        ]
    )
    return {
        "n_rows": rows,
        "layout": F.when(best["hits"] > 0, best["layout"]),
        "n_dates": best["hits"],
        "date_share": best["hits"] / rows,
        "becomes_date": best["hits"] / rows > DATE_SHARE,
    }


TEXT_PROFILE = (
    "seq int, column string, n_rows bigint, n_null bigint, n_trimmed bigint, has_marks boolean,"
    " n_numeric bigint, numeric_share double, becomes_numeric boolean, n_whole bigint, n_long bigint"
)
DATE_PROFILE = (
    "seq int, column string, n_rows bigint, layout string, n_dates bigint, date_share double,"
    " becomes_date boolean"
)


def _profile(df: DataFrame, names: list[str], facts: dict[str, Column], schema: str) -> DataFrame:
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    return long_text(df, names).groupBy("seq", "column").agg(
        *[fact.alias(name) for name, fact in facts.items()]
    )


def text_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per text column: gaps, amount marks and the share of rows that are numbers.

    A table without rows has no profile rows.
    """
    names = text_columns(df) if columns is None else columns
    return _profile(df, names, number_facts(), TEXT_PROFILE)


def date_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per text column: the date layout with most hits and its share of all rows."""
    names = text_columns(df) if columns is None else columns
    return _profile(df, names, date_facts(), DATE_PROFILE)


@dataclass(frozen=True)
class DateColumn:
    """The date column of a table; ``layout`` is set when it is still text."""

    name: str
    layout: str | None = None

    def expression(self) -> Column:
        if self.layout is None:
            return column(self.name)
        return parse_date(trim_text(column(self.name)), self.layout)


def find_date_column(df: DataFrame) -> DateColumn | None:
    """First native date column, else the first text column that mostly parses."""
    native = date_columns(df)
    if native:
        return DateColumn(native[0])
    found = date_profile(df).where("becomes_date").orderBy("seq").limit(1).collect()
    return DateColumn(found[0]["column"], found[0]["layout"]) if found else None


def with_date_column(df: DataFrame, found: DateColumn | None) -> DataFrame:
    """Retype the date column if it is text."""
    if found is None or found.layout is None:
        return df
    return df.withColumn(found.name, found.expression())


def column_roles(df: DataFrame) -> DataFrame:
    """Role of every column, from its type and, for text, from its content.

    A text column is numeric or date when enough of its rows parse; the date role
    goes only to the first such column, and only without a native date column.
    """
    roles = {field.name: role_of(field.dataType) for field in df.schema}
    facts = _profile(
        df, text_columns(df), number_facts() | date_facts(), f"{TEXT_PROFILE}, becomes_date boolean"
    ).orderBy("seq").select("column", "becomes_numeric", "becomes_date").collect()
    roles.update({fact["column"]: NUMERIC for fact in facts if fact["becomes_numeric"]})
    dates = [f["column"] for f in facts if f["becomes_date"] and not f["becomes_numeric"]]
    if dates and not date_columns(df):
        roles[dates[0]] = DATE
    return df.sparkSession.createDataFrame(
        [
            (seq, field.name, field.dataType.simpleString(), roles[field.name])
            for seq, field in enumerate(df.schema)
        ],
        "seq int, column string, data_type string, role string",
    )
