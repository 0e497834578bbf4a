"""Mixing sources to target weights by Poisson replication.

Each source gets a repetition rate: its share of the wanted total over its own size. A
document's number of copies is the Poisson quantile, with that rate as the mean, of a
number in [0, 1) hashed from a seed and the document's own key and text. So copies are
decided row by row, alike on every run and for every partitioning; a source's copies sum
to its target on average. Documents are exploded by their copies and dealt out by a hash
of (document, copy), sorted by it within each partition: a global random order.

Defined cases: a null source is a source of its own; null or empty text has one byte of
size, so that a source of empty texts has a finite rate; equal rows (same key, same text)
get equal numbers of copies, in neighbouring places; sources without a weight get none;
an empty table gives an empty result. Columns named like the added ones, in any case, are
replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import bounded_broadcast, every, hash_number, stage, table, unit_hash

SEED = 7
TEMPERATURE = 0.5  # a source's weight is its size to this power
EPOCHS = 1.0  # wanted total over the input's total
PIECE = 64.0  # rates are cut into pieces of at most this mean, whose counts add up
NULL_SOURCE = "\u0000null"


def source_sizes(docs: DataFrame, source: str, text: str) -> DataFrame:
    """One row for each source: rows and bytes, summed in every task before the shuffle."""
    return (
        docs.select(
            F.coalesce(F.col(source).cast("string"), F.lit(NULL_SOURCE)).alias("__source"),
            F.greatest(F.coalesce(F.octet_length(text), F.lit(0)), F.lit(1)).cast("long").alias("size"),
        )
        .groupBy("__source")
        .agg(F.sum("size").alias("size"))
    )


def tempered(sizes: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Weights in proportion to size ** temperature: (__source, size, weight)."""
    return sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))


def repetition_rates(weighted: DataFrame, epochs: float = EPOCHS) -> DataFrame:
    """(__source, rate): share of the wanted bytes over the source's own bytes."""
    size, weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    wanted = float(size or 0) * epochs / (weight or 1.0)
    return weighted.select("__source", (F.lit(wanted) * F.col("weight") / F.col("size")).alias("rate"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def poisson_steps(means: pd.Series) -> pd.Series:
    """Values of the distribution function, from 0 copies on until a double cannot tell it from 1."""

    def steps(mean: float) -> np.ndarray:
        reach = int(mean + 12.0 * np.sqrt(mean) + 32)
        k = np.arange(1, reach)
        terms = np.exp(-mean) * np.concatenate(([1.0], np.cumprod(mean / k)))
        return np.minimum(np.cumsum(terms), 1.0)

    return means.map(steps)


def poisson_copies(steps: Column, pieces: Column, *identity: Column | str | int) -> Column:
    """Quantile of a hashed number; a cut rate adds the quantiles of independent numbers."""

    def one(piece: Column) -> Column:
        draw = unit_hash(*identity, piece)
        return F.size(F.filter(steps, lambda step: step <= draw))

    return F.aggregate(
        F.sequence(F.lit(1), pieces), F.lit(0), lambda total, piece: total + one(piece)
    )


def mix(
    docs: DataFrame,
    rates: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """Every document as often as its source's rate and its own hash say, in random order.

    ``rates`` has (__source, rate), a row for each source. Adds ``copy`` (from 1),
    ``copies`` and ``shuffle_key``; the result is partitioned by that key and sorted in
    each partition.
    """
    added = {"copy", "copies", "shuffle_key", "__source", "rate", "pieces", "steps", "__digest"}
    docs = docs.select(*every([c for c in docs.columns if c.lower() not in added]))
    names = docs.columns
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    table_of_steps = rates.where("rate > 0").select(
        "__source", pieces.alias("pieces"), poisson_steps(F.col("rate") / pieces).alias("steps")
    )
    draws = docs.withColumn(
        "__source", F.coalesce(F.col(source).cast("string"), F.lit(NULL_SOURCE))
    ).withColumn("__digest", F.md5(F.coalesce(F.col(text), F.lit(""))))
    counted = draws.join(bounded_broadcast(table_of_steps, 20_000), "__source").withColumn(
        "copies",
        poisson_copies(F.col("steps"), F.col("pieces"), seed, F.col(key), F.col("__digest")),
    )
    exploded = counted.where("copies > 0").select(
        *every(names),
        "__digest",
        "copies",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    shuffle_key = hash_number(f"{seed}:order", F.col(key), F.col("__digest"), F.col("copy"))
    return (
        exploded.withColumn("shuffle_key", shuffle_key)
        .drop("__digest")
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


def mix_tempered(docs: DataFrame, epochs: float = EPOCHS, temperature: float = TEMPERATURE) -> DataFrame:
    """Mix with weights that flatten the sources' sizes."""
    sizes = stage(source_sizes(docs, "source", "text"), "source-sizes")
    rates = stage(repetition_rates(tempered(sizes, temperature), epochs), "rates")
    return mix(docs, rates)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All copies of all documents, whole rows, in their global random order."""
    return mix_tempered(table(spark, sf_dir, "documents"))


#: The same draws: distribution functions by log-factorials, hashes from the same text.
OP2_SQL = rf"""
with sized as (
    select coalesce(source, chr(1)) src, sum(greatest(coalesce(strlen(text), 0), 1)) size
    from documents group by 1),
weighted as (select src, size, pow(size::double, 0.5) weight from sized),
rates as (
    select src, weight / sum(weight) over () * (sum(size) over ())::double / size rate from weighted),
cut as (select src, greatest(ceil(rate / 64.0), 1)::int pieces, rate / greatest(ceil(rate / 64.0), 1) mean from rates),
steps as (
    select src, pieces, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) over (partition by src order by k) cdf
    from cut, range(0, 200) t(k)),
listed as (select src, pieces, list(least(cdf, 1.0) order by k) cdf from steps group by 1, 2),
digested as (
    select *, coalesce(source, chr(1)) src, md5(coalesce(text, '')) digest,
           coalesce(doc_id::varchar, chr(0)) doc_key from documents),
cut_rows as (
    select d.*, l.cdf, unnest(range(1, l.pieces + 1)) piece from digested d join listed l on d.src = l.src),
drawn as (
    select *, ('0x' || substr(md5('{SEED}:' || doc_key || ':' || digest || ':' || piece), 1, 13))::bigint / {16**13}.0::double u
    from cut_rows),
counted as (
    select doc_id, text, lang, source, n_chars, digest, doc_key,
           sum(len(list_filter(cdf, lambda c: c <= u)))::int copies
    from drawn group by all having copies > 0),
copied as (select *, unnest(range(1, copies + 1)) n from counted)
select doc_id, text, lang, source, n_chars, copies, n::int as copy,
       ('0x' || substr(md5('{SEED}:order:' || doc_key || ':' || digest || ':' || n), 1, 15))::bigint as shuffle_key
from copied
"""
