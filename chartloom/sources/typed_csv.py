"""CSV with column types taken from the content.

Spark's own inference knows one null marker and turns date text into dates. Here any
number of markers is read as null and dates stay text, for the date detection to
judge. One pass finds the files whose cells may hold line breaks, so that all others are
split over many tasks; one profile pass finds the types; then comes a row-wise projection.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.numbers import NUMBER_TEXT, WHOLE_TEXT
from chartloom.functions.text import column

# Cells that mean "missing" in a typed CSV file.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Spellings of the two truth values.
TRUE_TEXT, FALSE_TEXT = ("True", "TRUE", "true"), ("False", "FALSE", "false")

# Quotes inside quoted cells are doubled, as most writers do.
CSV_QUOTING = {"quote": '"', "escape": '"'}

# Types that a cell can have, as bits; a missing cell can have any.
WHOLE, FITS, NUMBER, TRUTH, MISSING = 1, 2, 4, 8, 16
ANY_TYPE = WHOLE | FITS | NUMBER | TRUTH | MISSING

REJECT_COLUMN = "_rejected_row"


def csv_options(multi_line: bool, options: dict) -> dict:
    """A row with too few or too many cells stops the read."""
    strict = {"multiLine": str(multi_line).lower(), "mode": "FAILFAST", "columnPruning": "false"}
    return {**CSV_QUOTING, "header": "true", **strict, **options}


def files_by_breaks(spark: SparkSession, path: str) -> dict[bool, list[str]]:
    """The files whose cells may hold line breaks (True), and the others, from all their lines.

    The line in which such a cell begins has an odd number of quotes. Counts of quotes are
    added up by file in every task; only file names come to the driver.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    files = (
        spark.read.text(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.bool_or(quotes % 2 == 1).alias("breaks"))
    )
    found: dict[bool, list[str]] = {True: [], False: []}
    for row in files.collect():
        found[row["breaks"]].append(unquote(row["file"]))
    return {breaks: sorted(names) for breaks, names in found.items()}


def open_csv(
    spark: SparkSession, path: str, schema=None, multi_line: bool | None = None, options: dict | None = None
) -> DataFrame:
    """CSV with a header line; text columns unless a schema is given.

    With ``multi_line=None`` the files that prove to have no line break inside a cell are read
    in splits, the others whole, in one union.
    """
    options = options or {}
    files = {bool(multi_line): [path], not multi_line: []} if multi_line is not None else files_by_breaks(spark, path)
    if schema is None:
        schema = spark.read.options(**csv_options(bool(files[True]), options)).csv(path, inferSchema=False).schema
    given = {breaks: [path] for breaks, names in files.items() if names}
    if len(given) == 2:
        given = files
        base = unquote(path.rstrip("/"))
        if not any(name.endswith(base) for name in files[True] + files[False]) and not set("*?[{") & set(path):
            options = {"basePath": path, **options}
    parts = [
        spark.read.options(**csv_options(breaks, options)).schema(schema).csv(names)
        for breaks, names in (given or {False: [path]}).items()
    ]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _texts(values: tuple[str, ...]) -> str:
    return ", ".join(f"r'{value}'" for value in values)


def type_masks(df: DataFrame, null_markers: tuple[str, ...] = NULL_MARKERS) -> dict[str, int]:
    """The types that every cell of a column can have, as bits.

    Cells are judged in long form and their masks are joined by ``bit_and``: the plan is the same for any
    number of columns.
    """
    cells = df.selectExpr(f"posexplode(array({', '.join(map(_quoted, df.columns))})) as (seq, text)")
    text = F.col("text")
    missing = text.isNull() | text.isin(*null_markers) if null_markers else text.isNull()
    whole = F.when(text.try_cast("bigint").isNotNull(), WHOLE | FITS | NUMBER).otherwise(WHOLE | NUMBER)
    mask = (
        F.when(missing, ANY_TYPE)
        .when(text.rlike(WHOLE_TEXT), whole)
        .when(text.rlike(NUMBER_TEXT), NUMBER)
        .when(text.isin(*TRUE_TEXT, *FALSE_TEXT), TRUTH)
        .otherwise(0)
    )
    found = cells.groupBy("seq").agg(F.bit_and(mask).alias("mask")).collect()
    masks = {row["seq"]: row["mask"] for row in found}
    return {name: masks.get(seq, ANY_TYPE) for seq, name in enumerate(df.columns)}


def infer_types(df: DataFrame, null_markers: tuple[str, ...] = NULL_MARKERS) -> DataFrame:
    """Retype an all-text table: whole numbers, numbers, truth values, else text.

    A column without any value becomes double, so that it counts as numeric. Whole
    numbers that no bigint holds stay text, since a double would make some of them equal.
    """
    if not df.columns:
        return df
    typed = []
    for name, mask in type_masks(df, null_markers).items():
        cell = _quoted(name)
        if null_markers:
            cell = f"case when {cell} not in ({_texts(null_markers)}) then {cell} end"
        if mask & MISSING:
            cell = "cast(null as double)"
        elif mask & WHOLE:
            cell = f"try_cast(trim({cell}) as bigint)" if mask & FITS else cell
        elif mask & NUMBER:  # every cell has the shape of a number
            cell = f"try_cast({cell} as double)"
        elif mask & TRUTH:
            cell = f"({cell}) in ({_texts(TRUE_TEXT)})"
        typed.append(f"{cell} as {_quoted(name)}")
    return df.selectExpr(*typed)


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema=None,
    null_markers: tuple[str, ...] = NULL_MARKERS,
    multi_line: bool | None = None,
    **options,
) -> DataFrame:
    """CSV with header; a known ``schema`` saves the profile pass.

    ``multi_line`` says whether cells may hold line breaks; None finds out, by file.
    """
    opened = open_csv(spark, path, schema, multi_line, options)
    return opened if schema is not None else infer_types(opened, null_markers)


def _reason(row: Column, cells: int) -> Column:
    """Why a row was rejected: its cells are counted outside quotes."""
    bare = F.regexp_replace(row, r'"([^"]|"")*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    return (
        F.when(F.contains(bare, F.lit('"')), "open quote")
        .when(found < cells, "too few cells")
        .when(found > cells, "too many cells")
        .otherwise("unreadable cell")
    )


def read_csv_with_rejects(
    spark: SparkSession, path: str, typed: bool = True, multi_line: bool | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the others as (file, row, reason): nothing raises for a bad row.

    Types follow the good rows alone. Cells are expected to be separated by commas in the reasons.
    """
    header = open_csv(spark, path, None, multi_line, options).schema
    schema = T.StructType([*header.fields, T.StructField(REJECT_COLUMN, T.StringType())])
    kept_apart = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT_COLUMN, **options}
    rows = open_csv(spark, path, schema, multi_line, kept_apart)
    rejected = column(REJECT_COLUMN)
    good = rows.where(rejected.isNull()).select(*[column(name) for name in header.names])
    # The parsed cells are part of the result's plan: Spark reads no rejected rows by themselves.
    parsed = F.array(*[column(name) for name in header.names])
    rejects = rows.where(rejected.isNotNull() & parsed.isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), rejected.alias("row"), _reason(rejected, len(header)).alias("reason"),
        F.size(F.array_compact(parsed)).alias("n_read"),
    )
    return (infer_types(good) if typed else good), rejects
