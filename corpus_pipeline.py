"""The corpus pipeline: each stage works on all rows that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chartloom.llm.common import every, stage, table
from chartloom.llm.decontamination import without_contaminated
from chartloom.llm.mixing import mix_tempered
from chartloom.llm.ngram_join import one_of_each_component
from chartloom.llm.sharding import shard
from chartloom.llm.toxicity import without_toxic


# Columns that the mixing and sharding stages look at
NEEDED = ("doc_id", "text", "source")

# Rows of a batch of texts for Python workers, which keep a few batches each
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches, unless the session has its own setting."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic."""
    small_batches(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


# The near-duplicate stage's links
NEAR_WORDS, NEAR_PERCENT = 5, 80


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram links connect: the one with the least id."""
    small_batches(spark)
    return one_of_each_component(docs, NEAR_WORDS, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the share of benchmark text that makes them contaminated."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for; columns named like the operator's own stay."""
    plain = docs.toDF(*[c if c in NEEDED else f"column {i}" for i, c in enumerate(docs.columns)])
    return mix_tempered(plain).select(*every(plain.columns)).toDF(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their place in it, which replace columns of these names."""
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    plain = docs.select(*every(names)).toDF(*[c if c in NEEDED else f"column {i}" for i, c in enumerate(names)])
    return shard(plain).select(*every(plain.columns), "shard", "slot").toDF(*names, "shard", "slot")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Trained scores and hashed permutations have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
