"""Exact medians in two scans, without collecting a column anywhere.

The first scan sketches two values just around the middle of every column. The second one
counts the rows below them, and how often each value between them occurs: a distributed
count that is about a thousandth of the input at most, and is stored. On that table the
middle rank is closed in by counts over equal bins, until a bin holds one value. A value
repeated a billion times is one counted row. The counts are exact, so the sketch decides
only how much is stored, never the answer.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.numbers import without_nan
from chartloom.functions.text import column
from chartloom.operators.profile import rows_from_aggregates
from chartloom.operators.roles import numeric_columns
from chartloom.plans.staging import staged

SKETCH_ACCURACY = 5_000  # the sketch's rank is off by at most one part in so many
BINS = 1_000


def as_double(name: str) -> Column:
    return without_nan(column(name).cast("double"))


def middle(value: Column | str, accuracy: int = SKETCH_ACCURACY) -> Column:
    """Aggregate: two values around the median, from a sketch."""
    around = F.array(*[F.lit(0.5 + side * 2 / accuracy) for side in (-1, 1)])
    return F.percentile_approx(value, around, accuracy)


def exact_medians(
    df: DataFrame,
    columns: list[str] | None = None,
    accuracy: int = SKETCH_ACCURACY,
    sketched: dict[str, tuple[int, list[float] | None]] | None = None,
) -> dict[str, float | None]:
    """Median per numeric column, null where a column has no value.

    ``sketched`` has the number of values and the :func:`middle` of each column, if an
    earlier pass took them.
    """
    names = numeric_columns(df) if columns is None else columns
    if not names:
        return {}
    entries = [F.struct(F.lit(i).alias("i"), as_double(name).alias("value")) for i, name in enumerate(names)]
    values = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
    if sketched is None:
        found = values.groupBy("i").agg(F.count("value").alias("n"), middle("value", accuracy).alias("ends"))
        facts = {row["i"]: (row["n"], row["ends"]) for row in found.collect()}
    else:
        facts = {i: sketched[name] for i, name in enumerate(names) if sketched[name][0]}
    bounds = [facts[i][1] if i in facts else (None, None) for i in range(len(names))]
    low, high = (
        F.get(F.array(*[F.lit(b[side]).cast("double") for b in bounds]), F.col("i")) for side in (0, 1)
    )
    # What is below the bracket has no value here, and so is one group.
    inside = F.when(F.col("value") >= low, F.col("value"))
    counted = values.where(F.col("value") <= high).groupBy("i", inside.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counted = staged(counted, f"medians-{uuid.uuid4().hex}")
    ends = counted.groupBy("i").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("below"), F.min("value"), F.max("value")
    )
    searches = []
    for i, below, least, most in ends.collect():
        total = facts[i][0]
        searches += [_Search(i, rank, below, least, most) for rank in sorted({(total - 1) // 2, total // 2})]
    while open_ := [s for s in searches if s.answer is None]:
        _close_in(counted, open_)
    answers: dict[int, list[float]] = {i: [] for i in range(len(names))}
    for search in searches:
        answers[search.column].append(search.answer)
    return {name: sum(answers[i]) / len(answers[i]) if answers[i] else None for i, name in enumerate(names)}


def median_per_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exact medians as rows ``(column, median)``."""
    medians = exact_medians(df, columns)
    return df.sparkSession.createDataFrame(
        list(medians.items()), "column string, median double"
    )


def approximate_medians(
    df: DataFrame, columns: list[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Medians from one mergeable sketch per column, as rows ``(column, median)``."""
    names = numeric_columns(df) if columns is None else columns
    return rows_from_aggregates(
        df,
        [
            {
                "column": F.lit(name),
                "median": F.percentile_approx(as_double(name), 0.5, accuracy),
            }
            for name in names
        ],
        "column string, median double",
    )


@dataclass
class _Search:
    """One wanted rank of one column, among counted values from ``low`` to ``high``."""

    column: int
    rank: int
    below: int
    low: float
    high: float

    @property
    def answer(self) -> float | None:
        return self.low if self.low == self.high else None


def _close_in(counted: DataFrame, searches: list[_Search]) -> None:
    """One pass over the counted values: every search goes on in the bin that holds its rank."""
    entries = [
        F.struct(F.lit(s.column).alias("i"), F.lit(k).alias("search"), F.lit(s.low).alias("low"), F.lit(s.high).alias("high"))
        for k, s in enumerate(searches)
    ]
    asked = F.filter(F.array(*entries), lambda e: e["i"] == F.col("i"))
    rows = counted.where(F.col("value").isNotNull()).select("value", "n", F.inline(asked))
    # Infinite ends leave finite values between them: these share a bin, then get bins of their own.
    width = F.col("high") / BINS - F.col("low") / BINS
    step = F.floor(F.try_divide(F.col("value") - F.col("low"), width))
    even = F.greatest(F.lit(1), F.least(step, F.lit(BINS - 2)))
    bin_ = (
        F.when(F.col("value") == F.col("low"), 0)
        .when(F.col("value") == F.col("high"), BINS - 1)
        .otherwise(F.when(width < float("inf"), even).otherwise(1))
    )
    counts = (
        rows.where((F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
        .groupBy("search", bin_.alias("bin"))
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    by_search: dict[int, list] = {}
    for row in sorted(counts, key=lambda r: (r["search"], r["bin"])):
        by_search.setdefault(row["search"], []).append(row)
    for k, rows_of in by_search.items():
        search = searches[k]
        for row in rows_of:
            if search.rank < search.below + row["n"]:
                search.low, search.high = row["low"], row["high"]
                break
            search.below += row["n"]
