"""Opening a table: the reader follows from the suffix, or from a named format."""

from __future__ import annotations

import re
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.errors import MissingPathError, TableReadError, UnreadableTableError, UnsupportedFormatError
from chartloom.sources.json_documents import json_layout, read_column_documents, read_record_documents
from chartloom.sources.typed_csv import open_csv, read_typed_csv

CORRUPT_COLUMN = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def read_csv_strings(spark: SparkSession, path: str, multi_line: bool | None = None, **options) -> DataFrame:
    """CSV with a header line; every column stays text."""
    return open_csv(spark, path, None, multi_line, options)


def read_json_lines(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    """One JSON object per line; without a schema Spark infers one in an extra pass.

    Lines that are no JSON keep their text in a column of that name when the schema
    or the inference has one, and do not stop the read.
    """
    reader = spark.read.options(
        **{"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, **options}
    )
    return (reader.schema(schema) if schema else reader).json(path)


def read_json(spark: SparkSession, path: str, orient: str | None = None, **options) -> DataFrame:
    """JSON in any of three layouts: ``lines``, ``records`` (an array) or ``columns``.

    Without ``orient`` the whole content of all files decides, which costs a pass.
    """
    orient = orient or json_layout(spark, path)
    if orient == "lines":
        return read_json_lines(spark, path, **options)
    if orient == "records":
        return read_record_documents(spark, path, **options)
    if orient == "columns":
        return read_column_documents(spark, path, **options)
    raise UnsupportedFormatError(f"{path}: unknown JSON layout {orient!r}")


_TYPED: dict[str, Callable[..., DataFrame]] = {
    "parquet": read_parquet,
    "csv": read_typed_csv,
    "json": read_json,
    "jsonl": read_json_lines,
    "ndjson": read_json_lines,
}
_UNTYPED = {**_TYPED, "csv": read_csv_strings}


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, typed: bool = True, **options
) -> DataFrame:
    """Open the table at ``path``.

    The lower-cased suffix picks the reader. ``fmt`` overrides it and may be any data
    source that Spark knows; a path without suffix uses Spark's default source.
    ``typed=False`` leaves CSV columns as text.
    """
    suffix = re.search(r"\.([^./\\]+)/*$", path.lower())
    kind = (fmt or (suffix.group(1) if suffix else "")).lower()
    readers = _TYPED if typed else _UNTYPED
    if not kind:
        return guarded(path, lambda: spark.read.options(**options).load(path))
    if kind in readers:
        return guarded(path, lambda: readers[kind](spark, path, **options))
    if fmt:
        return guarded(path, lambda: spark.read.format(fmt).options(**options).load(path))
    raise UnsupportedFormatError(f"{path}: no reader for .{kind}; name a Spark data source as fmt")


def guarded(path: str, open_table: Callable[[], DataFrame]) -> DataFrame:
    """Turn Spark's errors while opening a table into :class:`TableReadError`."""
    try:
        return open_table()
    except TableReadError:
        raise
    except (PySparkException, Py4JJavaError) as error:
        reason = str(error).strip().splitlines()[0]
        if isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND":
            raise MissingPathError(f"{path}: {reason}") from error
        raise UnreadableTableError(f"{path}: {reason}") from error
