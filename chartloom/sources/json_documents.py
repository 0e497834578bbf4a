"""JSON documents: arrays of records, and objects of columns.

A document cannot be split, so one task reads one file; throughput comes from many
files. Arrays may span lines.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.errors import UnreadableTableError
from chartloom.functions.text import column
from chartloom.sources.typed_csv import infer_types

LARGEST_DOCUMENT = 2_000_000_000  # bytes that one string can hold


def read_record_documents(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    """Files that each hold an array of objects; one row per object."""
    reader = spark.read.options(**{"multiLine": "true", "mode": "FAILFAST", **options})
    return (reader.schema(schema) if schema else reader).json(path)


def _document_kind(value: Column) -> Column:
    """Layout of one whole document; null if it is none."""
    labels = F.map_values(F.from_json(value, "map<string,map<string,string>>"))
    first = F.array_sort(F.map_keys(labels[0]))
    alike = F.forall(F.transform(labels, lambda m: F.array_sort(F.map_keys(m))), lambda keys: keys == first)
    named = F.map_values(F.from_json(value, "map<string,string>"))
    nested = F.forall(named, lambda v: F.ltrim(v).startswith("{")) & (F.size(named) > 0)
    fits = F.try_parse_json(value).isNotNull()
    start = F.substring(F.ltrim(value), 1, 1)
    return (
        F.when(fits & (start == "["), "records")
        .when(fits & (start == "{") & nested & alike, "columns")
        .when(fits & (start == "{"), "lines")
    )


def json_layout(spark: SparkSession, path: str) -> str:
    """``lines``, ``records`` or ``columns``, from the whole content of every file.

    A file of several lines that are all objects holds lines; one pass over the lines of all
    files, in splits, finds these. A file of one line is judged by that line. Only the files left, which are
    documents over several lines, are read whole: an
    array is ``records``; an object is ``columns`` if all its values are objects with the same
    labels, else one line. Files that disagree, or fit nothing, raise an error.
    """
    filled = F.trim("value") != ""
    is_object = F.ltrim("value").startswith("{") & F.try_parse_json(F.col("value")).isNotNull()
    files = (
        spark.read.text(path)
        .where(filled)
        .groupBy(F.col("_metadata.file_path").alias("document"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count(F.lit(1)).alias("n"), F.bool_and(is_object).alias("objects"))
    )
    # File names and sizes only; what is read again is named by them.
    by_shape: dict[str, list[str]] = {"line": [], "document": []}
    found: dict[str | None, str] = {}
    for row in files.collect():
        if row["objects"] and row["n"] > 1:
            found.setdefault("lines", row["document"])
        elif row["n"] > 1 and row["size"] > LARGEST_DOCUMENT:
            raise UnreadableTableError(f"{row['document']}: no lines of objects, and too large for one document")
        else:
            by_shape["line" if row["n"] == 1 else "document"].append(unquote(row["document"]))
    for shape, names in by_shape.items():
        if names:
            rows = spark.read.text(names, wholetext=shape == "document").where(filled)
            kinds = rows.groupBy(_document_kind(F.col("value")).alias("kind")).agg(
                F.min(F.col("_metadata.file_path")).alias("document")
            )
            found.update({row["kind"]: row["document"] for row in kinds.collect()})
    if None in found:
        raise UnreadableTableError(f"{found[None]}: neither lines, records nor columns")
    if len(found) > 1:
        raise UnreadableTableError(f"{path}: files of different layouts: {found}")
    return next(iter(found), "lines")


def read_column_documents(
    spark: SparkSession, path: str, columns: list[str] | None = None
) -> DataFrame:
    """Files that each hold ``{column: {row label: value}}``; one row per label.

    The cells come out as text in long form and are pivoted on the column names,
    which take one small job to list unless they are given. Types follow the content.
    """
    documents = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("document"),
        F.from_json("value", "map<string,map<string,string>>").alias("columns"),
    )
    broken = documents.where("columns is null").select("document").first()
    if broken:
        raise UnreadableTableError(f"{broken['document']}: no object of columns")
    cells = documents.select(
        "document", F.explode("columns").alias("column", "cells")
    ).select("document", "column", F.explode("cells").alias("label", "value"))
    if columns is None:
        order = documents.select(F.posexplode(F.map_keys("columns")).alias("pos", "column"))
        listed = order.groupBy("column").agg(F.min("pos").alias("pos")).orderBy("pos", "column")
        columns = [row["column"] for row in listed.collect()]
    rows = (
        cells.groupBy("document", "label")
        .pivot("column", columns)
        .agg(F.first("value"))
        .select(*[column(name) for name in columns])
    )
    return infer_types(rows, null_markers=())
