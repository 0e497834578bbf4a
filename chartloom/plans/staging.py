"""Results that several passes share.

``staged`` writes a table once to the shared folder of the cluster and reads it back:
columnar, pruned by later passes, and still there when an executor is lost.
``kept`` does so across calls and applications, as long as the input files stay the same.
``reused`` keeps a table in executor memory for the length of a block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the function that makes its paths."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def shared_root(spark: SparkSession) -> str:
    """The folder set as ``spark.checkpoint.dir`` or by ``setCheckpointDir``, else the warehouse.

    Every executor reaches it.
    """
    root = (
        spark.conf.get(CHECKPOINT_DIR, None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get(WAREHOUSE_DIR)
    )
    return root.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """This application's folder, below the shared one; it goes away with everything in it when the application ends."""
    path = f"{shared_root(spark)}/chartloom/{spark.sparkContext.applicationId}"
    files, to_path = file_system(spark, path)
    files.mkdirs(to_path(path))
    files.deleteOnExit(to_path(path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the table below the shared folder and return a scan of it."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A table that comes in fewer partitions than there are cores, dealt out to all of them.

    Large tables come in more and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Identity of the files below the paths: their names, sizes and times. No file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    facts = F.xxhash64("path", "length", "modificationTime")
    row = listed.agg(
        F.count(F.lit(1)), F.sum("length"), F.bit_xor(facts), F.sum(facts.cast("decimal(20,0)")), F.max("modificationTime")
    ).first()
    return hashlib.md5(repr(tuple(row)).encode()).hexdigest()


def kept(spark: SparkSession, paths: str | list[str], build: Callable[[], DataFrame], **parameters) -> DataFrame:
    """The table that ``build`` makes from the files at ``paths``, made once for each state of the files.

    It is stored in the shared folder under the files' fingerprint and the parameters, and found there by
    every later call, of other applications too. A call that finds changed files builds anew and
    removes what was made of the files as they were.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    told = json.dumps([paths, sorted(parameters.items())], default=str)
    folder = f"{shared_root(spark)}/chartloom-kept/{hashlib.md5(told.encode()).hexdigest()}"
    state = fingerprint(spark, paths)
    files, to_path = file_system(spark, folder)
    if not files.exists(to_path(f"{folder}/{state}/_SUCCESS")):
        build().write.mode("overwrite").parquet(f"{folder}/{state}")
        for other in files.listStatus(to_path(folder)):
            if other.getPath().getName() != state:
                files.delete(other.getPath(), True)
    return spark.read.parquet(f"{folder}/{state}")


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep the table in memory (spilling to disk) while the block runs."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
