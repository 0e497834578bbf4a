"""Automatic cleaning of any table: trim, retype, fill.

One summary of all columns comes before the row-wise plan: it decides which
columns become numbers and brackets their medians. Two more scans find the medians and modes of the
columns that have gaps. Only those per-column facts reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.numbers import nan_to_null, number
from chartloom.functions.text import column, drop_marks, trim_text
from chartloom.operators.impute import filled_number, filled_text, mode_values
from chartloom.operators.median import exact_medians
from chartloom.operators.profile import text_profile
from chartloom.operators.roles import numeric_columns, text_columns
from chartloom.operators.summary import TEXT_FIELDS, ColumnFacts, column_facts, exact_numbers

REPORT_SCHEMA = "seq int, action string, column string, n_changed bigint, fill_value string, message string"


def text_facts(df: DataFrame) -> list[ColumnFacts]:
    """Facts of all text columns, in schema order, without the sketches of a full summary."""
    found = text_profile(df).orderBy("seq").collect()
    return [exact_numbers(ColumnFacts(row["column"], *(row[f] for f in TEXT_FIELDS))) for row in found]


def retype_text(df: DataFrame, facts: list[ColumnFacts], strip_all: bool = False) -> DataFrame:
    """Trim text columns and turn the numeric ones into whole numbers or doubles.

    Amount marks leave only the columns that become numbers. With ``strip_all`` they
    leave every column in which one occurs, converted or not.
    """
    changes = {}
    for fact in facts:
        text = trim_text(column(fact.name))
        if fact.becomes_numeric:
            text = drop_marks(text)
            text = text.try_cast("bigint") if fact.is_whole else number(text)
        elif strip_all and fact.has_marks:
            text = drop_marks(text)
        changes[fact.name] = text
    return df.withColumns(changes) if changes else df


def convert_text(df: DataFrame, strip_all: bool = False) -> DataFrame:
    """Profile, then :func:`retype_text`: the cleaning without the filling."""
    return retype_text(df, text_facts(df), strip_all)


@dataclass(frozen=True)
class Fills:
    """What fills the gaps of a retyped table, and how many there were."""

    medians: dict[str, float]
    modes: dict[str, str]
    gaps: dict[str, int]
    expressions: dict[str, Column]


def gap_fills(
    typed: DataFrame, rows: int, facts: dict[str, ColumnFacts], known_modes: dict[str, str] | None = None
) -> Fills:
    """Medians and modes of the columns of a retyped table that have gaps and values.

    ``facts`` are those of the table before it was retyped; modes that are known already are not sought.
    """
    gaps = {n: rows - f.n_numeric if f.becomes_numeric else f.n_null for n, f in facts.items()}
    some = [n for n in typed.columns if 0 < gaps.get(n, 0) < rows]
    numbers = [n for n in numeric_columns(typed) if n in some]
    texts = [n for n in text_columns(typed) if n in some]
    medians = exact_medians(typed, numbers, sketched={n: (facts[n].n_numbers, facts[n].middle) for n in numbers})
    modes = dict(known_modes or {})
    modes |= mode_values(typed, [n for n in texts if n not in modes])
    modes = {n: modes[n] for n in texts}
    fills = {n: filled_number(n, medians[n], typed.schema[n].dataType, bool(facts[n].n_long)) for n in numbers}
    fills |= {n: filled_text(n, modes[n]) for n in texts}
    return Fills(medians, modes, gaps, fills)


def auto_clean(df: DataFrame, strip_all: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return the cleaned table and a report of what was changed.

    Afterwards only columns without any value still have gaps. A whole-number column with
    gaps becomes a double, since a median need not be whole; one of text with numbers too
    long for that stays whole if the median is, else it becomes a decimal.
    """
    df = nan_to_null(df)
    rows, by_name = column_facts(df)
    facts = [by_name[name] for name in text_columns(df)]
    typed = retype_text(df, facts, strip_all)
    fills = gap_fills(typed, rows, by_name)
    cleaned = typed.withColumns(fills.expressions) if fills.expressions else typed

    steps = [
        ("trimmed", f.name, f.n_trimmed, None, f"White space removed at the ends of {f.name}")
        for f in facts
        if f.n_trimmed
    ]
    converted = [f for f in facts if f.becomes_numeric]
    steps += [
        ("converted", f.name, f.n_numeric, None, f"Text in {f.name} read as numbers")
        for f in converted
    ]
    if not converted:
        steps.append(("nothing_to_convert", None, 0, None, "No text column holds mostly numbers"))
    steps += [
        ("filled_median", n, fills.gaps[n], repr(value), f"Gaps in {n} filled with the median")
        for n, value in fills.medians.items()
    ]
    steps += [
        ("filled_mode", n, fills.gaps[n], value, f"Gaps in {n} filled with the most frequent value")
        for n, value in fills.modes.items()
    ]
    if not fills.expressions:
        steps.append(("nothing_to_fill", None, 0, None, "No gap could or had to be filled"))
    report = df.sparkSession.createDataFrame(
        [(seq, *step) for seq, step in enumerate(steps)], REPORT_SCHEMA
    )
    return cleaned, report
