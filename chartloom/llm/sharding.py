"""Sharding by a two-pass external shuffle.

Pass one scatters rows into memory-sized buckets by a seeded hash; pass two shuffles each
bucket on its own (Fisher-Yates) and writes it. A bucket belongs to one shard, and a
shard's slots run through its buckets in order, so a shard read by slot is a random
permutation of its rows.

The law is ``key``: a row's shard depends on its key and the number of shards alone (jump
consistent hash), so one more shard takes rows into itself and moves no others.

Defined cases: a null key is a key like any other; null text has no bytes; equal rows stay
separate rows; an empty table gives an empty result; extra columns travel along. A shard has as
many buckets as its own bytes ask for, so one that a hot key fills has more of them. Rows of a
key that takes a quarter of a bucket are spread over the buckets of its shard, and so are equal
ones: copies are counted first, with partial sums in each task, and numbered on.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import bounded_broadcast, every, stage, table

SHARDS = 24
SEED = 20240229
BUCKET_BYTES = 16 << 20  # what a task holds at a time


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a 64-bit hash: with one more shard, rows move into that one only."""

    @F.pandas_udf(T.IntegerType())
    def jump(hashes: pd.Series) -> pd.Series:
        state = hashes.to_numpy(dtype=np.int64).view(np.uint64).copy()
        home = np.full(len(state), -1, dtype=np.int64)
        following = np.zeros(len(state), dtype=np.int64)
        open_ = following < shards
        while open_.any():
            home[open_] = following[open_]
            state[open_] = state[open_] * np.uint64(2862933555777941757) + np.uint64(1)
            draw = (state[open_] >> np.uint64(33)).astype(np.float64) + 1.0
            following[open_] = ((home[open_] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            open_ = following < shards
        return pd.Series(home.astype(np.int32))

    return jump(key)


def key_hash(key: str, seed: int) -> Column:
    """Seeded hash of the key's text; null has a hash of its own."""
    return F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("\u0000null")))


def utf8_size(column: str) -> Column:
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("long") + 8


def _numbered(docs: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    """Rows with a ``copy`` number that tells rows of a crowded key apart.

    A key with at most ``limit`` bytes fits a bucket and needs none. The few others (at most
    all bytes / limit) have their equal rows counted and the copies numbered; their rows differ
    by content or by number, and so does the hash that places them.
    """
    names = docs.columns
    text_key = F.coalesce(F.col(key).cast("string"), F.lit("\u0000null"))
    counted = docs.select(text_key.alias("__key"), utf8_size(text).alias("__n")).groupBy("__key").agg(F.sum("__n").alias("__n"))
    crowded = stage(counted.where(F.col("__n") > limit).select("__key"), "crowded-keys")
    if crowded.isEmpty():
        return docs.withColumn("__copy", F.lit(0).cast("long"))
    crowded = bounded_broadcast(crowded)
    keyed = docs.withColumn("__key", text_key)
    few = keyed.join(crowded, "__key", "left_anti").select(*every(names), F.lit(0).cast("long").alias("__copy"))
    many = (
        keyed.join(crowded, "__key", "left_semi")
        .groupBy(*every(names))
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*every(names), F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("__copy"))
    )
    return few.unionByName(many)


def _fisher_yates(seed: int):
    """Shuffles one bucket: rows in an order of their own first, then a seeded permutation."""

    def shuffled(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        rows = rows.take(pa.compute.sort_indices(rows, [("__order", "ascending")]))
        order = np.arange(rows.num_rows)
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)  # Fisher-Yates
        rows = rows.take(pa.array(order)).drop_columns(["__order"])
        return rows.append_column("place", pa.array(np.arange(len(order), dtype=np.int64)))

    return shuffled


def shard(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows and columns of ``docs``, with ``shard``, ``slot``, ``bucket`` and ``place``.

    The shuffled buckets are written to the shared folder, bucket by bucket; the result
    scans them and adds the slot. Columns of the input named like these four, in any
    case, are left out of the result. A shard's number of buckets follows from its own bytes.
    """
    taken = {"shard", "slot", "bucket", "place", "__order", "__copy", "__key", "__n"}
    docs = docs.select(*every([c for c in docs.columns if c.lower() not in taken]))
    home = jump_shard(key_hash(key, seed), shards)
    # One small row for each shard: its bytes tell how many buckets it has, and where they begin.
    sizes = docs.select(home.alias("shard"), utf8_size(text).alias("size")).groupBy("shard").agg(F.sum("size"))
    per_shard = [1] * shards
    for number, size in sizes.collect():
        per_shard[number] = max(1, -(-size // bucket_bytes))
    offsets = [0, *itertools.accumulate(per_shard[:-1])]
    numbered = _numbered(docs, key, text, max(1, bucket_bytes // 4))
    identity = F.xxhash64(F.lit(seed), *every(docs.columns), F.col("__copy"))
    spread = F.pmod(F.xxhash64(identity, F.lit("bucket")), F.get(F.lit(per_shard), F.col("shard")))
    placed = (
        numbered.withColumn("shard", home)
        .withColumn("bucket", (F.get(F.lit(offsets), F.col("shard")) + spread).cast("long"))
        .withColumn("__order", identity)
        .drop("__copy")
    )
    # Grouped functions take columns by name, where a dot would mean a field: number them.
    names = placed.columns[:-1]
    numbered = placed.toDF(*[c if c in ("shard", "bucket", "__order") else f"c{i}" for i, c in enumerate(placed.columns)])
    schema = T.StructType([*numbered.schema.fields[:-1], T.StructField("place", T.LongType())])
    shuffled = numbered.groupBy("bucket").applyInArrow(_fisher_yates(seed), schema)
    written = stage(shuffled.toDF(*names, "place"), "shards")
    # Where each bucket starts in its shard: one small row for each bucket.
    starts = (
        written.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n"))
        .select("bucket", "before")
    )
    return (
        written.join(bounded_broadcast(starts), "bucket")
        .withColumn("slot", F.col("before") + F.col("place"))
        .drop("before")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document went, with a digest of what was written there."""
    docs = shard(table(spark, sf_dir, "documents"))
    return docs.select(
        "doc_id",
        utf8_size("text").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        jump_shard(key_hash("doc_id", SEED), SHARDS + 1).alias("grown_shard"),
    )
