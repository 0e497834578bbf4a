"""Mixing and sharding."""

from __future__ import annotations

import zlib

import pytest
from llm_frames import documents
from pyspark.sql import functions as F

from chartloom.llm.common import unit_hash
from chartloom.llm.mixing import mix, mix_tempered, poisson_copies, poisson_steps
from chartloom.llm.sharding import SHARDS, jump_shard, op3_sharding, shard


def digest(df):
    return sorted(map(repr, df.collect()))


def test_shards_hold_every_row_once(spark, small):
    given = spark.read.parquet(f"{small}/documents.parquet")
    found = op3_sharding(spark, small).collect()
    want = sorted(
        (r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32(r["text"].encode())) for r in given.collect()
    )
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(SHARDS))


def test_jump_hash_spreads_evenly_and_moves_only_into_the_new_shard(spark):
    rows = spark.range(40_000).withColumn("h", F.xxhash64("id"))
    rows = rows.select(jump_shard(F.col("h"), 10).alias("ten"), jump_shard(F.col("h"), 11).alias("eleven"))
    counted = {(r["ten"], r["eleven"]): r["count"] for r in rows.groupBy("ten", "eleven").count().collect()}
    assert all(a == b or b == 10 for a, b in counted)
    assert all(3_500 < sum(n for (a, _), n in counted.items() if a == s) < 4_500 for s in range(10))


def test_hot_key_is_spread_over_buckets_and_repeats_stay(spark):
    rows = [(7, "hot")] * 3_000 + [(7, f"hot {i}") for i in range(500)] + [(i, f"cold {i}") for i in range(100, 1_100)]
    found = shard(documents(spark, rows), shards=2, bucket_bytes=4_000)
    counts = found.where("doc_id = 7").groupBy("shard", "bucket").count().collect()
    assert len({r["shard"] for r in counts}) == 1
    assert max(r["count"] for r in counts) < 3 * 3_500 / len(counts)
    assert digest(found.select("doc_id", "text")) == digest(documents(spark, rows).select("doc_id", "text"))
    assert digest(found) == digest(shard(documents(spark, rows).repartition(7), shards=2, bucket_bytes=4_000))


def test_buckets_stay_near_their_size_whatever_the_keys(spark):
    """A hot key of different rows, one of equal rows and one with few but long rows, beside many small keys."""
    rows = [(7, f"hot {i:05d} " + "x" * 72) for i in range(6_000)] + [(8, "same " * 18)] * 3_000
    rows += [(9, f"{i} " + "long " * 1_000) for i in range(40)] + [(i, f"cold {i}") for i in range(100, 700)]
    found = shard(documents(spark, rows), bucket_bytes=20_000)
    size = F.sum(F.octet_length("text") + 8)
    buckets = found.groupBy("shard", "bucket").agg(size.alias("n")).collect()
    assert max(r["n"] for r in buckets) < 2.5 * 20_000
    assert found.groupBy("shard", "slot").count().where("count > 1").isEmpty()
    assert found.groupBy("shard").agg((F.max("slot") + 1 - F.count("slot")).alias("gap")).where("gap <> 0").isEmpty()
    assert digest(found.select("doc_id", "text")) == digest(documents(spark, rows).select("doc_id", "text"))


def test_odd_rows_in_shards(spark, odd, none, clashing):
    found = shard(odd, shards=3)
    assert digest(found.select("doc_id", "text")) == digest(odd.select("doc_id", "text"))
    assert shard(none).collect() == []
    wide = shard(clashing, shards=3)
    assert "x5" not in wide.columns and wide.count() == odd.count() and "a.b" in wide.columns


def test_poisson_inversion(spark):
    rate = 3.7
    rows = spark.range(20_000).withColumn("steps", poisson_steps(F.lit(rate)))
    found = rows.select(poisson_copies(F.col("steps"), F.lit(1), "s", F.col("id")).alias("n"), unit_hash("s", F.col("id"), F.lit(1)).alias("u"))
    stats = found.agg(F.avg("n"), F.var_samp("n"), F.min("n")).first()
    assert stats[0] == pytest.approx(rate, abs=0.06) and stats[1] == pytest.approx(rate, abs=0.2) and stats[2] == 0


def test_copies_reach_the_target(spark):
    rows = [(i, f"text {i}", "many" if i % 10 else "few") for i in range(5_000)]
    rates = spark.createDataFrame([("many", 0.5), ("few", 100.0)], "__source string, rate double")
    found = {r["source"]: r["count"] for r in mix(documents(spark, rows), rates).groupBy("source").count().collect()}
    assert found["many"] == pytest.approx(2_250, rel=0.1) and found["few"] == pytest.approx(50_000, rel=0.02)


def test_same_mix_for_any_partitioning(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert digest(mix_tempered(docs)) == digest(mix_tempered(docs.repartition(5)))


def test_odd_rows_in_the_mix(spark, odd, none, clashing):
    found = mix_tempered(odd, epochs=50.0)
    assert {r["doc_id"] for r in found.collect()} == {r["doc_id"] for r in odd.collect()}
    assert mix_tempered(none).collect() == []
    assert mix_tempered(clashing, epochs=3.0).count() == mix_tempered(odd, epochs=3.0).count()
