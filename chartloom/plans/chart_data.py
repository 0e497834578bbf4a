"""All chart data of a table, chosen from its roles, each chart a lazy DataFrame."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.dates import parse_date
from chartloom.functions.numbers import nan_to_null
from chartloom.functions.text import column
from chartloom.operators import charts
from chartloom.operators.frequency import long_frequencies, low_cardinality
from chartloom.operators.profile import DATE_SHARE, DateColumn, find_date_column, with_date_column
from chartloom.operators.roles import date_columns, numeric_columns, text_columns, trend_measure
from chartloom.operators.summary import ColumnFacts, column_facts
from chartloom.plans.auto_clean import gap_fills, retype_text
from chartloom.plans.staging import spread, staged

# A column suits a bar chart or colours with more than one and fewer
# than this many values, a share chart with fewer than this many.
BAR_LIMIT = 20
SHARE_LIMIT = 10


@dataclass(frozen=True)
class ChartColumns:
    """The column each chart uses; None leaves the chart out."""

    kpis: list[str] = field(default_factory=list)
    date: str | None = None
    trend: str | None = None
    bar: str | None = None
    share: str | None = None
    histogram: str | None = None
    correlation: list[str] = field(default_factory=list)
    scatter_x: str | None = None
    scatter_y: str | None = None
    colours: list[str] = field(default_factory=list)

    def used(self) -> list[str]:
        """Every column that a chart needs, once."""
        single = (self.date, self.trend, self.bar, self.share, self.histogram)
        names = [*self.kpis, *self.correlation, *single, self.scatter_x, self.scatter_y]
        return list(dict.fromkeys(name for name in names if name))


def _first_between(columns: list[str], distinct: dict[str, int], limit: int) -> str | None:
    suited = [name for name in columns if 1 < distinct.get(name, limit) < limit]
    return (suited or columns or [None])[0]


def colour_candidates(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Categorical columns that can colour a scatter plot."""
    names = text_columns(df) if columns is None else columns
    distinct = low_cardinality(df, names, BAR_LIMIT)
    return [name for name in names if distinct.get(name, 0) > 1]


def choose_columns(df: DataFrame, date: str | None = None, distinct: dict[str, int] | None = None) -> ChartColumns:
    """Defaults for every chart. The date column must already have a date type.

    ``distinct`` has the number of values of the columns with few, if that is known.
    """
    numeric, categorical = numeric_columns(df), text_columns(df)
    if distinct is None:
        distinct = low_cardinality(df, categorical, BAR_LIMIT)
    follow = bool(date and numeric)
    two = len(numeric) >= 2
    return ChartColumns(
        kpis=numeric[: charts.KPI_COLUMNS],
        date=date if follow else None,
        trend=trend_measure(numeric) if follow else None,
        bar=None if follow else _first_between(categorical, distinct, BAR_LIMIT),
        share=_first_between(categorical, distinct, SHARE_LIMIT),
        histogram=numeric[0] if numeric else None,
        correlation=numeric if two else [],
        scatter_x=numeric[0] if two else None,
        scatter_y=numeric[1] if two else None,
        colours=[name for name in categorical if distinct.get(name, 0) > 1],
    )


LISTS = ("kpis", "correlation", "colours")
SINGLE = ("date", "trend", "bar", "share", "histogram", "scatter_x", "scatter_y")


def default_columns(df: DataFrame) -> DataFrame:
    """The choices as rows ``(chart, place, column)``: one for each single column, and one for each of a list."""
    found = find_date_column(df)
    chosen = choose_columns(with_date_column(df, found), found and found.name)
    rows = [(chart, 0, getattr(chosen, chart)) for chart in SINGLE]
    rows += [(chart, place, name) for chart in LISTS for place, name in enumerate(getattr(chosen, chart))]
    return df.sparkSession.createDataFrame(rows, "chart string, place int, column string")


def chart_data(
    df: DataFrame,
    clean: bool = True,
    bins: int = 20,
    grid: int = 50,
    stage: bool | None = None,
    scatter_rows: int | None = None,
    **columns,
) -> dict[str, DataFrame]:
    """Chart name -> data, on the cleaned table or (``clean=False``) on the raw one.

    Keyword arguments named like the fields of :class:`ChartColumns` replace a
    default; ``colour`` names the colour column of the scatter plot. Each chart
    scans only the columns it needs.

    The raw table is scanned twice at most: for the summary of its columns, and to write the
    columns that the charts can use, typed, to the shared folder; medians, modes, counts and charts read
    that copy. ``stage=False`` leaves it out, ``stage=True`` writes it also where nothing
    is parsed. ``scatter_rows`` adds single points, an exact sample
    of so many rows, to the grid of all.
    """
    colour = columns.pop("colour", None)
    data, found, distinct = _prepared(nan_to_null(df), clean, stage, [colour, *columns.values()])
    data = with_date_column(data, found)
    chosen = replace(choose_columns(data, found and found.name, distinct), **columns)
    days, ends = _extents(data, chosen)
    built: dict[str, DataFrame] = {}
    if chosen.kpis:
        built["kpis"] = charts.kpi_totals(data, chosen.kpis)
    if chosen.date and chosen.trend:
        built["trend"] = charts.trend_auto(data, chosen.date, chosen.trend, days)
    elif chosen.bar:
        built["bar"] = charts.top_n_with_other(data, chosen.bar, charts.BAR_VALUES)
    if chosen.share:
        built["share"] = charts.category_share(data, chosen.share)
    if chosen.histogram:
        built["histogram"] = charts.histogram(
            data, chosen.histogram, bins, ends[chosen.histogram]
        )
    if chosen.correlation:
        built["correlation"] = charts.correlation_matrix(data, chosen.correlation)
    if chosen.scatter_x and chosen.scatter_y:
        x, y = chosen.scatter_x, chosen.scatter_y
        built["scatter_grid"] = charts.scatter_grid(data, x, y, colour, grid, [ends[x], ends[y]])
        if scatter_rows is not None:
            built["scatter"] = charts.scatter_points(data, x, y, colour, scatter_rows)
    return built


def _prepared(
    df: DataFrame, clean: bool, stage: bool | None, asked: list
) -> tuple[DataFrame, DateColumn | None, dict[str, int]]:
    """The columns that charts can use, typed and filled; the date column; the columns with few values."""
    rows, facts = column_facts(df, trimmed=clean)
    typed = retype_text(df, [facts[name] for name in text_columns(df)]) if clean else df
    texts = text_columns(typed)
    few = [name for name in texts if facts[name].n_distinct <= BAR_LIMIT]
    native = date_columns(typed)
    dates = [] if native else [n for n in texts if _dates_at_most(facts[n], clean) > DATE_SHARE * rows]
    named = {name for entry in asked for name in (entry if isinstance(entry, list) else [entry])}
    # The first two texts: one may be the date, the other is the fallback of the category charts.
    wanted = {*numeric_columns(typed), *few, *native, *dates, *texts[:2], *named}
    data = typed.select(*[column(name) for name in typed.columns if name in wanted])
    if stage is None:
        stage = clean or bool(dates)
    if stage and data.columns:
        data = staged(spread(data), f"charts-{uuid.uuid4().hex}")
    counts: dict[str, dict[str, int]] = {name: {} for name in few}
    for row in long_frequencies(data, few).where("value is not null").collect() if few else ():
        counts[row["column"]][row["value"]] = row["n"]
    modes = {name: min(c, key=lambda v: (-c[v], v.encode())) for name, c in counts.items() if c}
    if clean:
        fills = gap_fills(data, rows, facts, modes)
        modes |= fills.modes
        data = data.withColumns(fills.expressions) if fills.expressions else data
    found = DateColumn(native[0]) if native else next(
        (DateColumn(n, facts[n].layout) for n in dates if _is_date(df, facts[n], rows, modes.get(n) if clean else None)), None
    )
    return data, found, {name: len(c) for name, c in counts.items() if len(c) < BAR_LIMIT}


def _dates_at_most(facts: ColumnFacts, filled: bool) -> int:
    """Dates that a text column can have once its gaps are filled."""
    return (facts.n_dates + (facts.n_null if filled else 0)) if facts.n_dates else 0


def _is_date(df: DataFrame, facts: ColumnFacts, rows: int, mode: str | None) -> bool:
    """Whether enough of a column is dates; what fills its gaps may be one, too."""
    if facts.n_dates > DATE_SHARE * rows:
        return True
    return mode is not None and bool(
        df.sparkSession.range(1).select(parse_date(F.lit(mode), facts.layout).isNotNull()).first()[0]
    )


def _extents(data: DataFrame, chosen: ChartColumns) -> tuple[Column | None, dict[str, charts.Bounds]]:
    """Days spanned by the dates and ends of the binned columns, in one pass for all charts."""
    measured = (chosen.histogram, chosen.scatter_x, chosen.scatter_y)
    binned = list(dict.fromkeys(name for name in measured if name))
    facts = charts.end_aggregates(binned)
    if chosen.date:
        facts.append(charts.days_spanned(chosen.date).alias("days"))
    if not facts:
        return None, {}
    row = data.agg(*facts).first()
    ends = {
        name: charts.Bounds(*(F.lit(row[f"{end}{i}"]).cast("double") for end in ("low", "high")))
        for i, name in enumerate(binned)
    }
    return (F.lit(row["days"]).cast("bigint") if chosen.date else None), ends


# Chart -> the columns of its long form that it has.
_LONG_FORM = {
    "kpis": {"series": "column", "label": "display", "value": "total"},
    "trend": {"series": "grain", "label": "period", "value": "mean"},
    "bar": {"series": "is_other", "label": "value", "value": "n", "n": "n"},
    "share": {"series": "is_other", "label": "value", "value": "share", "n": "n"},
    "histogram": {"label": "bin", "value": "n", "n": "n", "low": "bin_start", "high": "bin_end"},
    "correlation": {"series": "col_x", "label": "col_y", "value": "r", "n": "n"},
    "scatter_grid": {"series": "x_bin", "label": "y_bin", "value": "n", "n": "n", "colour": "colour"},
}
_LONG_TYPES = {
    "series": "string", "label": "string", "value": "double", "n": "bigint", "low": "double", "high": "double",
    "colour": "string",
}


def chart_table(built: dict[str, DataFrame]) -> DataFrame:
    """The bounded charts as one table ``(chart, series, label, value, n, low, high, colour)``."""
    parts = []
    for chart, names in _LONG_FORM.items():
        if chart in built:
            there = set(built[chart].columns)
            cells = [
                (F.col(names[c]) if names.get(c) in there else F.lit(None)).cast(kind).alias(c)
                for c, kind in _LONG_TYPES.items()
            ]
            parts.append(built[chart].select(F.lit(chart).alias("chart"), *cells))
    if not parts:
        raise ValueError("the table has no column that a chart can use")
    return reduce(DataFrame.unionByName, parts)
