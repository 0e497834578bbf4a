"""Writers. Data goes from the executors to the target, never through the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from chartloom.errors import TableWriteError
from chartloom.plans.staging import file_system
from chartloom.sources.typed_csv import CSV_QUOTING


def write_csv(df: DataFrame, path: str) -> str:
    """Write CSV with header, one file per partition."""
    df.write.mode("overwrite").options(**CSV_QUOTING).option("header", True).csv(path)
    return path


def write_csv_file(df: DataFrame, path: str) -> str:
    """Write one CSV file with exactly this name, in place of a file that has it.

    Spark writes a folder aside; when it is complete, its only part gets the name by a rename, so no
    reader meets half a file. A folder of that name is left alone and raises.
    """
    aside = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    files, to_path = file_system(df.sparkSession, path)
    target = to_path(path)
    if files.exists(target) and files.getFileStatus(target).isDirectory():
        raise TableWriteError(f"{path}: a folder has this name")
    try:
        # One task writes the rows; the stages that compute them keep their parallelism.
        write_csv(df.repartition(1), aside)
        parts = [s.getPath() for s in files.listStatus(to_path(aside)) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise TableWriteError(f"{path}: {len(parts)} parts were written")
        files.delete(target, False)
        if not files.rename(parts[0], target):
            raise TableWriteError(f"{path}: the finished file could not be renamed")
    finally:
        files.delete(to_path(aside), True)
    return path


def write_sample_csv(sample: DataFrame, path: str) -> str:
    """Write a sample (which is bounded by its row number) as one CSV file."""
    return write_csv_file(sample, path)


def write_parquet(df: DataFrame, path: str) -> str:
    """Write Parquet, for results of any size."""
    df.write.mode("overwrite").parquet(path)
    return path
