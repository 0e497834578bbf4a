"""Sampling and previews.

The exact sample takes the ``n`` rows with the smallest hashes. It is unbiased, repeats for
a seed whatever the partitioning, follows one rule at every size, and has exactly
``min(n, rows)`` rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions.text import column
from chartloom.plans.staging import staged

# Fixed values
SAMPLE_ROWS = 100_000
OVERSAMPLE = 1.2
PREVIEW_ROWS = 5

BERNOULLI_DIGITS = 13  # hexadecimal digits that a share is compared with

HASH_LENGTH = 32  # hexadecimal digits of a hash
DIGITS_A_PASS = 4
NULL_KEY = "\u0000"  # no key reads like this


def sampling_fraction(total: int, n: int = SAMPLE_ROWS) -> float:
    """Share of the rows that a Bernoulli sample of about ``n`` rows needs."""
    return min(1.0, OVERSAMPLE * n / total) if total else 1.0


def sample_fraction(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The same share as a one-row table, with the row count it comes from."""
    rows = F.count(F.lit(1))
    wanted = F.try_divide(F.lit(OVERSAMPLE * n), rows)
    return df.agg(
        rows.alias("n_rows"), F.least(F.lit(1.0), F.coalesce(wanted, F.lit(1.0))).alias("fraction")
    )


def bernoulli_sample(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """Keep each row with the given probability, decided by its hash: alike for any partitioning.

    ``key`` names a unique column; without it the whole row is hashed, and equal rows stay
    or go together.
    """
    digits = F.conv(F.substring(row_hash(df, seed, key), 1, BERNOULLI_DIGITS), 16, 10).cast("bigint")
    return df.where(digits < F.lit(round(fraction * 16**BERNOULLI_DIGITS)))


def preview(df: DataFrame, order_by: list[str] | None = None, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows: in storage order, or by a key for a repeatable result."""
    ordered = df.orderBy(*[column(name) for name in order_by]) if order_by else df
    return ordered.limit(n)


def row_hash(df: DataFrame, seed: int, key: str | None, unique_key: bool = True) -> Column:
    """Hash of a unique key alone, or of the key (if any) and the whole row."""
    parts = [F.lit(str(seed))]
    if key is not None:
        parts.append(F.coalesce(column(key).cast("string"), F.lit(NULL_KEY)))
    if key is None or not unique_key:
        parts.append(F.to_json(F.struct(*[column(c) for c in df.columns]), {"ignoreNullFields": "false"}))
    return F.md5(F.concat_ws(":", *parts))


def exact_sample(
    df: DataFrame,
    n: int = SAMPLE_ROWS,
    seed: int = 0,
    key: str | None = None,
    unique_key: bool = False,
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, drawn without bias: those with the smallest hashes.

    Rows are hashed as a whole, together with ``key``; ``unique_key`` hashes the key alone,
    which reads less. The n-th smallest hash is found digit by digit: a pass counts rows
    by the next digits (65,536 counts at most), and every pass after the first works on a
    stored copy of the few rows that can still be in the sample. Rows are then filtered by
    that hash, so no task ever holds the sample. Equal rows share a hash: their copies come
    back by number, as many as are wanted.
    """
    name = "__row_hash"
    near = df.withColumn(name, row_hash(df, seed, key, unique_key))
    known, before = "", 0
    while len(known) < HASH_LENGTH:
        digits = F.substring(name, len(known) + 1, DIGITS_A_PASS)
        counts = near.where(column(name).startswith(known)).groupBy(digits.alias("digits")).count().collect()
        for found in sorted(counts):
            if before + found["count"] >= n:
                break
            before += found["count"]
        else:
            return df  # fewer rows than wanted, or as many
        known += found["digits"]
        bounded = near.where(F.substring(name, 1, len(known)) <= known)
        if before + found["count"] == n:
            return bounded.drop(name)
        near = staged(bounded, f"sample-{uuid.uuid4().hex}") if len(known) == DIGITS_A_PASS else bounded
    # More rows share the n-th hash than are wanted of them: count the copies, take the first.
    copies = near.where(column(name) == known).groupBy(*[column(c) for c in df.columns]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    whole = F.to_json(F.struct(*[column(c) for c in df.columns]))
    running = F.sum("__copies").over(
        Window.orderBy(F.md5(whole), whole).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    wanted = F.least(F.col("__copies"), F.lit(n - before) - (running - F.col("__copies")))
    last = (
        copies.withColumn("__wanted", wanted)
        .where("__wanted > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__wanted")))
    )
    names = [column(c) for c in df.columns]
    return near.where(column(name) < known).select(*names).unionByName(last.select(*names))


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per input partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
