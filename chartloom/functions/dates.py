"""Date expressions: parsing by a fixed list of layouts, spans and periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------------
# Layout name -> (shape of the text, mark between the parts, parts in order). No parts: an ISO cast.
# Where a value fits several layouts, and a column does throughout, the one listed first counts.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
MONTH = r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
FULL_MONTH = r"(January|February|March|April|May|June|July|August|September|October|November|December)"
CLOCK = r"\d{1,2}:\d{2}(:\d{2})?"
ISO_LOCAL = r"\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
LAYOUTS = {
    "iso_date": (r"^\d{4}-\d{1,2}-\d{1,2}$", "-", ""),
    "iso_timestamp": (f"^{ISO_LOCAL}$", "-", ""),
    "slashed": (r"^\d{1,2}/\d{1,2}/\d{4}$", "/", "mdy"),
    "month_name": (rf"^{MONTH} \d{{1,2}}, \d{{4}}$", " ", "Mdy"),
    "compact": (r"^\d{8}$", "", "ymd"),
    "slashed_time": (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {CLOCK}$", "/", "mdyt"),
    "year_first": (r"^\d{4}/\d{1,2}/\d{1,2}$", "/", "ymd"),
    "day_month": (rf"^\d{{1,2}}-{MONTH}-\d{{4}}$", "-", "dMy"),
    "full_month": (rf"^{FULL_MONTH} \d{{1,2}}, \d{{4}}$", " ", "Mdy"),
    "day_slashed": (r"^\d{1,2}/\d{1,2}/\d{4}$", "/", "dmy"),
    "day_slashed_time": (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {CLOCK}$", "/", "dmyt"),
    "dotted": (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ".", "dmy"),
    "plain_month": (rf"^{MONTH} \d{{1,2}} \d{{4}}$", " ", "Mdy"),
    "day_full_month": (rf"^\d{{1,2}} {FULL_MONTH} \d{{4}}$", " ", "dMy"),
    "day_month_name": (rf"^\d{{1,2}} {MONTH} \d{{4}}$", " ", "dMy"),
    "iso_offset": (rf"^({ISO_LOCAL}) ?(Z|[+-]\d{{2}}(?::?\d{{2}})?)$", "-", ""),
}
LENGTHS = (6, 40)  # of any date text
# Grain -> spans of more than this many whole days use it; coarsest first.
GRAIN_SPANS = {"year": 730, "month": 90, "week": 7}
# ------------------------------------------------------------------------------

GRAINS = (*GRAIN_SPANS, "day")


def _at_utc(text: Column) -> Column:
    """Local time less its offset: the same moment whatever the session's time zone."""
    shape = LAYOUTS["iso_offset"][0]
    zone = F.regexp_replace(F.regexp_extract(text, shape, 2), ":", "")
    minutes = F.coalesce(F.substring(zone, 2, 2).try_cast("int") * 60, F.lit(0)) + F.coalesce(
        F.substring(zone, 4, 2).try_cast("int"), F.lit(0)
    )
    east = F.when(F.startswith(zone, F.lit("-")), -minutes).otherwise(minutes)
    return F.timestamp_add("MINUTE", -east, F.regexp_extract(text, shape, 1).try_cast("timestamp_ntz"))


def _parsed(text: Column, layout: str) -> Column:
    """The date of a text of the layout's shape: its parts in ISO order, cast without any formatter."""
    _, mark, order = LAYOUTS[layout]
    if layout == "iso_offset":
        return _at_utc(text)
    if not order:
        return text.try_cast("timestamp_ntz")
    if layout == "compact":
        parts = {"y": F.substring(text, 1, 4), "m": F.substring(text, 5, 2), "d": F.substring(text, 7, 2)}
    else:
        day = F.substring_index(text, " ", 1) if "t" in order else text
        middle = F.substring_index(F.substring_index(day, mark, 2), mark, -1)
        parts = dict(zip(order, (F.substring_index(day, mark, 1), middle, F.substring_index(day, mark, -1))))
    if "M" in parts:
        place = F.call_function("instr", F.lit(MONTHS), F.substring(parts["M"], 1, 3))
        parts["m"] = F.floor((place + 2) / 3).cast("string")
        parts["d"] = F.replace(parts["d"], F.lit(","), F.lit(""))
    iso = F.concat_ws("-", parts["y"], parts["m"], parts["d"])
    if "t" in order:
        iso = F.concat_ws(" ", iso, F.substring_index(text, " ", -1))
    return iso.try_cast("timestamp_ntz")


def parse_date(text: Column, layout: str) -> Column:
    """Text in the given layout, as a timestamp without time zone (in UTC if it has an offset); else null."""
    return F.when(text.rlike(LAYOUTS[layout][0]), _parsed(text, layout))


def fitting_layouts(text: Column) -> Column:
    """The layouts in which the text is a date, as bits by their place in the list; 0 if it is none.

    Only layouts whose mark the text has are looked at, and each of their shapes is tested once.
    """
    bit = {layout: 1 << place for place, layout in enumerate(LAYOUTS)}
    by_mark: dict[str, dict[str, list[str]]] = {mark: {} for mark in ("/", "-", ".", " ", "")}
    for layout, (shape, mark, _) in LAYOUTS.items():
        by_mark[mark].setdefault(shape, []).append(layout)
    chain = F
    for mark, shapes in by_mark.items():
        of_mark = F
        for shape, layouts in shapes.items():
            fits = [F.when(_parsed(text, layout).isNotNull(), bit[layout]).otherwise(0) for layout in layouts]
            of_mark = of_mark.when(text.rlike(shape), reduce(lambda one, other: one + other, fits))
        chain = chain.when(F.contains(text, F.lit(mark)), of_mark.otherwise(0))
    could_be = F.length(text).between(*LENGTHS) & text.rlike("^[0-9A-Z]") & text.rlike("[0-9Z]$")
    return F.when(could_be, chain).otherwise(0)


def span_days(first: Column, last: Column) -> Column:
    """Whole days from the first instant to the last."""
    return F.timestamp_diff("DAY", first, last)


def grain_for(days: Column) -> Column:
    """Name of the time grain that suits a span."""
    grain = F.lit("day")
    for name, limit in sorted(GRAIN_SPANS.items(), key=lambda item: item[1]):
        grain = F.when(days > limit, F.lit(name)).otherwise(grain)
    return grain


def period_start(moment: Column, grain: str) -> Column:
    """First day of the period that holds the moment; weeks start on Monday.

    Works on dates, so the session time zone never enters for zone-less columns.
    """
    day = moment.cast("date")
    if grain == "day":
        return day
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; use one of {', '.join(GRAINS)}")
    return F.trunc(day, grain)
