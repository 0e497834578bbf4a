"""Sampling: exact size, repeatability and hot groups."""

from __future__ import annotations

from collections import Counter

import pytest

from chartloom.operators import sample


def keys(df, name="id"):
    return sorted(r[name] for r in df.collect())


@pytest.mark.parametrize("n, total", [(10, 1000), (999, 1000), (1000, 1000), (5000, 1000), (1, 1)])
def test_exact_size(spark, n, total):
    rows = spark.range(total)
    assert sample.exact_sample(rows, n, 3, "id").count() == min(n, total)
    assert sample.exact_sample(rows, n, 3).count() == min(n, total)


def test_repeats_whatever_the_partitioning(spark):
    one = keys(sample.exact_sample(spark.range(0, 5000, 1, 1), 100, 3, "id"))
    many = keys(sample.exact_sample(spark.range(0, 5000, 1, 16), 100, 3, "id"))
    assert one == many
    assert keys(sample.exact_sample(spark.range(5000), 100, 4, "id")) != one


def test_draws_from_the_whole_table(spark):
    drawn = keys(sample.exact_sample(spark.range(10_000), 1000, 5, "id"))
    tenths = Counter(value // 1000 for value in drawn)
    assert len(tenths) == 10 and min(tenths.values()) > 60


def test_hot_copies_are_drawn_with_multiplicity(spark):
    rows = spark.range(9000).selectExpr("if(id < 6000, 0, id) as id", "map('k', 'v') as m")
    for seed in range(3):
        drawn = sample.exact_sample(rows, 50, seed)
        assert drawn.count() == 50 and drawn.columns == ["id", "m"]
        assert keys(drawn) == keys(sample.exact_sample(rows.repartition(7), 50, seed))
    whole = sample.exact_sample(rows, 8000, 1)
    assert 5000 <= sum(value == 0 for value in keys(whole)) <= 6000
    assert max(Counter(value for value in keys(whole) if value).values()) == 1


@pytest.mark.parametrize("total", [9_000, 400_000])
def test_one_rule_for_a_repeating_key_at_any_size(spark, total):
    rows = spark.range(total).selectExpr("id % 4 as key", "id")
    drawn = sample.exact_sample(rows, 100, 3, "key")
    again = sample.exact_sample(rows.repartition(7), 100, 3, "key")
    assert keys(drawn) == keys(again) and drawn.count() == 100
    assert {r["key"] for r in drawn.collect()} == {0, 1, 2, 3}


def test_null_and_empty_keys_differ(spark):
    rows = spark.createDataFrame([(None,), ("",)], "key string")
    hashes = rows.select(sample.row_hash(rows, 1, "key").alias("h")).distinct()
    assert hashes.count() == 2


def test_empty_table(spark):
    assert sample.exact_sample(spark.range(0), 5, 1, "id").count() == 0
    assert sample.sample_fraction(spark.range(0), 5).first()["fraction"] == 1.0


def test_bernoulli_repeats_for_a_seed(spark):
    rows = spark.range(0, 10_000, 1, 4)
    first = keys(sample.bernoulli_sample(rows, 0.1, 9))
    assert first == keys(sample.bernoulli_sample(rows, 0.1, 9))
    assert 800 < len(first) < 1200


def test_partition_rows(spark):
    assert sorted(r["n_rows"] for r in sample.partition_rows(spark.range(0, 10, 1, 2)).collect()) == [5, 5]
