"""Files that Spark derives from the given tables, for the readers to read back.

They go below the shared folder of the session. Documents are built in
groups of a fixed number of key values, so no task ever holds more than that.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.plans.staging import shared_folder

RECORDS_PER_DOCUMENT = 20_000


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder per application, input and query."""
    digest = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    return f"{shared_folder(spark)}/{digest}/{name}"


def write_documents(documents: DataFrame, path: str) -> str:
    """One text file per row of the single column ``document``."""
    documents.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def record_documents(df: DataFrame, key: str) -> DataFrame:
    """Arrays of the rows of ``df``, one document per range of the (unique) key."""
    record = F.to_json(F.struct(*df.columns))
    return (
        df.groupBy(F.floor(F.col(key) / RECORDS_PER_DOCUMENT).alias("part"))
        .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(record)), F.lit("]")).alias("document"))
        .select("document")
    )


def line_documents(df: DataFrame, key: str, line: Column, header: str) -> DataFrame:
    """Texts of a header and one line for each row of ``df``, one text per range of the (unique) key."""
    return (
        df.groupBy(F.floor(F.col(key) / RECORDS_PER_DOCUMENT).alias("part"))
        .agg(F.concat_ws("\n", F.lit(header), F.collect_list(line)).alias("document"))
        .select("document")
    )


def column_documents(df: DataFrame, key: str) -> DataFrame:
    """Objects ``{column: {row label: value}}``, labelled by the (unique) key."""
    label = F.col(key).cast("string")
    return (
        df.groupBy(F.floor(F.col(key) / RECORDS_PER_DOCUMENT).alias("part"))
        .agg(
            *[
                F.map_from_entries(F.collect_list(F.struct(label, F.col(name)))).alias(name)
                for name in df.columns
            ]
        )
        .select(F.to_json(F.struct(*df.columns)).alias("document"))
    )


def run_id() -> str:
    """Name part of a folder that no other run uses."""
    return uuid.uuid4().hex[:12]
