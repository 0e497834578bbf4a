"""One mergeable summary of every column, in one scan.

All cells of the text and number columns are put in long form and grouped by their column, so the plan is
the same for any width: gaps, what trimming and marks do, numbers and dates in text, a sketch of the
middle of the numbers and a sketch of the number of values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.dates import fitting_layouts
from chartloom.functions.numbers import number
from chartloom.functions.text import drop_marks, trim_text
from chartloom.operators.median import middle
from chartloom.operators.profile import date_facts, number_facts
from chartloom.operators.roles import numeric_columns, text_columns
from chartloom.plans.staging import spread


@dataclass(frozen=True)
class ColumnFacts:
    """What the summary, or a text profile, says about one column."""

    name: str
    n_null: int
    n_trimmed: int = 0
    has_marks: bool = False
    n_numeric: int = 0
    becomes_numeric: bool = False
    n_whole: int = 0
    n_long: int = 0
    layout: str | None = None
    n_dates: int = 0
    n_numbers: int = 0
    middle: list[float] | None = None
    n_distinct: int = 0  # estimate

    @property
    def is_whole(self) -> bool:
        """All numbers are whole and fit: the column becomes a bigint."""
        return self.becomes_numeric and self.n_whole == self.n_numeric


TEXT_FIELDS = ("n_null", "n_trimmed", "has_marks", "n_numeric", "becomes_numeric", "n_whole", "n_long")


def column_facts(df: DataFrame, trimmed: bool = True) -> tuple[int, dict[str, ColumnFacts]]:
    """Number of rows, and the facts of all text and number columns.

    Values are told apart trimmed, or as they are. Floating-point columns must have nulls in place of NaN.
    """
    texts, numbers = text_columns(df), numeric_columns(df)
    names = texts + numbers
    if not names:
        return df.count(), {}
    quoted = ["`" + name.replace("`", "``") + "`" for name in names]
    cells = [
        f"named_struct('value', cast({q} as string), 'given', cast(null as double))"
        if i < len(texts)
        else f"named_struct('value', cast(null as string), 'given', cast({q} as double))"
        for i, q in enumerate(quoted)
    ]
    long = spread(df).selectExpr(f"posexplode(array({', '.join(cells)})) as (i, cell)").select(
        "i", "cell.value", "cell.given", trim_text(F.col("cell.value")).alias("text")
    )
    long = long.withColumns({"bare": drop_marks(F.col("text")), "layouts": fitting_layouts(F.col("text"))})
    long = long.withColumn("number", number(F.col("bare")))
    parsed = F.coalesce("given", "number")
    facts = number_facts(F.col("number").isNotNull()) | date_facts()
    facts |= {
        "n_null": F.count_if(F.col("text").isNull() & F.col("given").isNull()),
        "n_numbers": F.count(parsed),
        "middle": middle(parsed),
        "n_distinct": F.approx_count_distinct("text" if trimmed else "value"),
    }
    found = long.groupBy("i").agg(*[fact.alias(name) for name, fact in facts.items()]).collect()
    by_place = {row["i"]: row for row in found}
    if not by_place:
        return 0, {name: ColumnFacts(name, 0) for name in names}
    fields = (*TEXT_FIELDS, "layout", "n_dates", "n_numbers", "middle", "n_distinct")
    return by_place[0]["n_rows"], {
        name: exact_numbers(ColumnFacts(name, *(by_place[i][f] for f in fields))) if i < len(texts)
        else ColumnFacts(name, by_place[i]["n_null"], n_numbers=by_place[i]["n_numbers"], middle=by_place[i]["middle"])
        for i, name in enumerate(names)
    }


def exact_numbers(facts: ColumnFacts) -> ColumnFacts:
    """A double would make long whole numbers equal that are not: such text stays text."""
    if facts.n_long and facts.n_whole < facts.n_numeric:
        return ColumnFacts(**{**vars(facts), "becomes_numeric": False})
    return facts
