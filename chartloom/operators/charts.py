"""The data behind each chart, computed on the whole table.

Statistics that a row expression needs (bounds, spans, totals) enter the plan as
scalar subqueries: one row each, evaluated once before the main stage, no join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions.dates import GRAINS, grain_for, period_start, span_days
from chartloom.functions.numbers import two_decimals, without_nan
from chartloom.functions.text import column
from chartloom.operators.frequency import frequencies
from chartloom.operators.median import as_double
from chartloom.operators.profile import rows_from_aggregates
from chartloom.operators.roles import numeric_columns
from chartloom.operators.sample import exact_sample

# Fixed values
KPI_COLUMNS = 4
BAR_VALUES = 15
SHARE_VALUES = 10
OTHER_LABEL = "Other"

ROUNDING = 1e-14  # of a mean: a standard deviation below counts as none


# Totals ------------------------------------------------------------------------


def total(name: str) -> Column:
    """Sum without gaps, 0 when there is no value; exact for integers that fit."""
    value = column(name)
    return F.coalesce(
        without_nan(F.try_sum(value).cast("double")), F.sum(as_double(name)), F.lit(0.0)
    )


def kpi_totals(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Totals of the first numeric columns, with their display form, in one pass."""
    names = numeric_columns(df)[:KPI_COLUMNS] if columns is None else columns
    return rows_from_aggregates(
        df,
        [
            {
                "seq": F.lit(seq),
                "column": F.lit(name),
                "total": total(name),
                "display": two_decimals(total(name)),
            }
            for seq, name in enumerate(names)
        ],
        "seq int, column string, total double, display string",
    )


# Trends ------------------------------------------------------------------------


def days_spanned(date: str) -> Column:
    """Aggregate: whole days between the first and the last moment."""
    moment = column(date).cast("timestamp_ntz")
    return span_days(F.min(moment), F.max(moment))


def date_span(df: DataFrame, date: str) -> DataFrame:
    """First and last moment, and the whole days between them."""
    moment = column(date).cast("timestamp_ntz")
    return df.agg(
        F.min(moment).alias("first"), F.max(moment).alias("last"), days_spanned(date).alias("days")
    )


def _mean_per_period(df: DataFrame, date: str, measure: str, period: Column) -> DataFrame:
    return (
        df.where(column(date).isNotNull())
        .groupBy(period.alias("period"))
        .agg(F.avg(as_double(measure)).alias("mean"))
        .orderBy("period")
    )


def trend(df: DataFrame, date: str, measure: str, grain: str) -> DataFrame:
    """Mean of the measure per year, month, week or day."""
    return _mean_per_period(df, date, measure, period_start(column(date), grain))


def trend_auto(df: DataFrame, date: str, measure: str, days: Column | None = None) -> DataFrame:
    """Mean per period, with the grain that suits the span of the dates."""
    grain = grain_for(date_span(df, date).select("days").scalar() if days is None else days)
    period = reduce(
        lambda chain, name: chain.when(grain == name, period_start(column(date), name)),
        GRAINS[1:],
        F.when(grain == GRAINS[0], period_start(column(date), GRAINS[0])),
    )
    return _mean_per_period(df, date, measure, period).select("period", grain.alias("grain"), "mean")


# Categories --------------------------------------------------------------------


def top_n_with_other(
    df: DataFrame, name: str, n: int = BAR_VALUES, label: str = OTHER_LABEL
) -> DataFrame:
    """The ``n`` most frequent values and, if any are left, their remainder.

    A real value equal to the label keeps its own row; ``is_other`` tells them apart.
    The remainder is the total minus the top, so the tail is never sorted.
    """
    counted = frequencies(df, name)
    top = counted.orderBy(F.desc("n"), "value").limit(n)
    everything = counted.agg(F.sum("n")).scalar()
    rest = top.agg((everything - F.sum("n")).alias("n")).where("n > 0")
    return top.select(F.col("value").cast("string"), "n", F.lit(False).alias("is_other")).unionByName(
        rest.select(F.lit(label).alias("value"), "n", F.lit(True).alias("is_other"))
    )


def category_share(df: DataFrame, name: str, n: int = SHARE_VALUES) -> DataFrame:
    """The same with each row's share of all non-null values."""
    everything = frequencies(df, name).agg(F.sum("n")).scalar()
    return top_n_with_other(df, name, n).withColumn("share", F.col("n") / everything)


# Distributions -----------------------------------------------------------------


def _finite(name: str) -> Column:
    value = as_double(name)
    return F.when(F.abs(value) != float("inf"), value)


@dataclass(frozen=True)
class Bounds:
    """Smallest and largest finite value of a column, as expressions."""

    low: Column
    high: Column


def end_aggregates(names: list[str]) -> list[Column]:
    """Aggregates ``low0, high0, low1, ...``: the finite ends of each column."""
    ends = []
    for i, name in enumerate(names):
        ends += [F.min(_finite(name)).alias(f"low{i}"), F.max(_finite(name)).alias(f"high{i}")]
    return ends


def bounds_of(df: DataFrame, *names: str) -> list[Bounds]:
    """The ends of each column, all from one scalar subquery."""
    ends = df.agg(F.struct(*end_aggregates(list(names))).alias("ends")).scalar()
    return [Bounds(ends[f"low{i}"], ends[f"high{i}"]) for i in range(len(names))]


def _bin(value: Column, ends: Bounds, bins: int) -> Column:
    """Equal-width bin number; the ends (and infinities) go to the outer bins."""
    low, high = ends.low, ends.high
    return (
        F.when(value <= low, 0)
        .when(value >= high, bins - 1)
        .otherwise(F.least(F.floor((value - low) / ((high - low) / bins)), F.lit(bins - 1)))
        .cast("int")
    )


def histogram(df: DataFrame, name: str, bins: int = 20, ends: Bounds | None = None) -> DataFrame:
    """Rows per equal-width bin of one numeric column; empty bins are left out."""
    ends = ends or bounds_of(df, name)[0]
    width = (ends.high - ends.low) / bins
    value = as_double(name)
    return (
        df.where(value.isNotNull())
        .groupBy(_bin(value, ends, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (ends.low + F.col("bin") * width).alias("bin_start"),
            (ends.low + (F.col("bin") + 1) * width).alias("bin_end"),
            "n",
        )
        .orderBy("bin")
    )


# Relations ---------------------------------------------------------------------


MOMENTS = ("n", "mx", "my", "xx", "yy", "xy", "bad")  # count, means, centred squares and products
UNSURE = 1e-6  # of the squares: a spread below this is centred anew on the pair's own rows


def _batch_moments(values: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of all pairs of columns over the rows where both exist.

    Values are moved by their column's median, and matrix products give all pairs at once. Where
    little is left of the squares, the rows of that pair lie elsewhere: it is taken by itself.
    """
    infinite = np.isinf(values)
    there = ~np.isnan(values)
    values = np.where(infinite, np.nan, values)
    some = ~np.isnan(values).all(axis=0)
    shift = np.zeros(values.shape[1])
    shift[some] = np.nanmedian(values[:, some], axis=0)
    mask, moved = there.astype(float), np.nan_to_num(values - shift)
    n = mask.T @ mask
    least = np.maximum(n, 1)
    sums = moved.T @ mask
    mean_x = sums / least
    squares = (moved * moved).T @ mask
    spread = squares - n * mean_x * mean_x
    products = moved.T @ moved - n * mean_x * mean_x.T
    endless = infinite.T.astype(float) @ mask
    bad = endless + endless.T
    unsure = (n > 1) & (bad == 0) & (spread < UNSURE * squares)
    mx, my = mean_x + shift[:, None], (mean_x + shift[:, None]).T
    xx, yy = spread.copy(), spread.T.copy()
    for i, j in zip(*np.nonzero(np.triu(unsure | unsure.T))):
        both = there[:, i] & there[:, j]
        x, y = values[both, i], values[both, j]
        x_off, y_off = x - x.mean(), y - y.mean()
        mx[i, j], my[i, j] = x.mean(), y.mean()
        xx[i, j], yy[i, j], products[i, j] = x_off @ x_off, y_off @ y_off, x_off @ y_off
    return dict(zip(MOMENTS, (n, mx, my, xx, yy, products, bad)))


def _joined_moments(one: dict[str, np.ndarray], other: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of two sets of rows together: centred sums grow by the distance of the means."""
    n = one["n"] + other["n"]
    share = np.divide(other["n"], n, out=np.zeros_like(n), where=n > 0)
    x, y = other["mx"] - one["mx"], other["my"] - one["my"]
    weight = one["n"] * share
    return {
        "n": n,
        "mx": one["mx"] + x * share,
        "my": one["my"] + y * share,
        "xx": one["xx"] + other["xx"] + x * x * weight,
        "yy": one["yy"] + other["yy"] + y * y * weight,
        "xy": one["xy"] + other["xy"] + x * y * weight,
        "bad": one["bad"] + other["bad"],
    }


def _pair_moments(width: int):
    """One row of moments for each pair of columns, for one task."""
    one, other = np.triu_indices(width)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                found = _batch_moments(batch.to_numpy(dtype=float))
                total = found if total is None else _joined_moments(total, found)
        if total is not None:
            yield pd.DataFrame({"i": one, "j": other} | {name: total[name][one, other] for name in MOMENTS})

    return moments


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every cell ``(col_x, col_y, r, n)`` of the correlation matrix, in one scan.

    ``r`` is null where it is undefined: a constant column, an infinite value, or fewer
    than two rows. Each task hands on one row of centred moments for each pair of columns; they are joined
    by the rule for means and co-moments, so no value far from the others spoils the rest.
    """
    names = numeric_columns(df) if columns is None else columns
    if not names:
        return df.sparkSession.createDataFrame([], "col_x string, col_y string, r double, n bigint")
    doubles = df.select(*[as_double(name).alias(f"c{i}") for i, name in enumerate(names)])
    schema = "i int, j int, " + ", ".join(f"{name} double" for name in MOMENTS)
    of_tasks = doubles.mapInPandas(_pair_moments(len(names)), schema)
    pair = Window.partitionBy("i", "j")

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(F.col("n") * F.col(name)).over(pair), F.sum("n").over(pair))

    off = of_tasks.withColumns({"x": mean("mx"), "y": mean("my")}).withColumns(
        {"dx": F.col("mx") - F.col("x"), "dy": F.col("my") - F.col("y")}
    )
    summed = off.groupBy("i", "j", "x", "y").agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.expr("xx + n * dx * dx")).alias("xx"),
        F.sum(F.expr("yy + n * dy * dy")).alias("yy"),
        F.sum(F.expr("xy + n * dx * dy")).alias("xy"),
    )

    def spread(mean: str, squares: str) -> Column:
        """Null for a constant: what is left of it is rounding of its mean."""
        return F.when(F.col(squares) > F.col("n") * F.pow(F.col(mean) * ROUNDING, 2), F.col(squares))

    r = F.col("xy") / (F.sqrt(spread("x", "xx")) * F.sqrt(spread("y", "yy")))
    r = F.when(F.col("i") == F.col("j"), F.when(r.isNotNull(), 1.0)).otherwise(
        F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    )
    measured = summed.select(
        "i", "j", F.when((F.col("bad") == 0) & (F.col("n") > 1), r).alias("r"), F.col("n").cast("bigint").alias("n")
    )
    # A table without rows has every cell, too.
    width = len(names)
    every = df.sparkSession.range(width * width).select(
        (F.col("id") / width).cast("int").alias("i"), (F.col("id") % width).cast("int").alias("j")
    ).where("i <= j")
    measured = every.join(measured, ["i", "j"], "left").select("i", "j", "r", F.coalesce("n", F.lit(0)).alias("n"))
    listed = F.array(*[F.lit(name) for name in names])
    one = F.struct(F.col("i").alias("x"), F.col("j").alias("y"))
    other = F.struct(F.col("j").alias("x"), F.col("i").alias("y"))
    cells = F.when(F.col("i") == F.col("j"), F.array(one)).otherwise(F.array(one, other))
    return measured.select(F.explode(cells).alias("cell"), "r", "n").select(
        F.get(listed, F.col("cell.x")).alias("col_x"), F.get(listed, F.col("cell.y")).alias("col_y"), "r", "n"
    )


def scatter_points(
    df: DataFrame,
    x: str,
    y: str,
    colour: str | None = None,
    n: int | None = None,
    seed: int = 0,
    key: str | None = None,
    unique_key: bool = False,
) -> DataFrame:
    """One point per row; with ``n``, an exact sample of that many rows."""
    rows = df if n is None else exact_sample(df, n, seed, key, unique_key)
    points = [column(x).alias("x"), column(y).alias("y")]
    return rows.select(*points, *([column(colour).alias("colour")] if colour else []))


def scatter_grid(
    df: DataFrame,
    x: str,
    y: str,
    colour: str | None = None,
    bins: int = 50,
    ends: list[Bounds] | None = None,
) -> DataFrame:
    """Rows per cell of an equal-width grid: the scatter plot with a bounded size."""
    across, up = ends or bounds_of(df, x, y)
    keys = [
        _bin(as_double(x), across, bins).alias("x_bin"),
        _bin(as_double(y), up, bins).alias("y_bin"),
    ]
    if colour:
        keys.append(column(colour).alias("colour"))
    return (
        df.where(as_double(x).isNotNull() & as_double(y).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
