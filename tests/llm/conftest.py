from __future__ import annotations

import pytest
from llm_frames import ODD_ROWS, documents


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD_ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns named like what the operators use and add, in odd case."""
    from pyspark.sql import functions as F

    names = (
        "Shard SLOT bucket place copy copies shuffle_key score predicted votes kept n_words words lines count n"
        " doc digest rank start length item at rate size weight Held_Out word steps a.b"
    ).split()
    return odd.select("*", *[F.lit(f"x{i}").alias(name) for i, name in enumerate(names)])


@pytest.fixture(scope="session")
def tables(tmp_path_factory):
    """Writes tables below a folder of their own, like the given ones."""

    def write(**frames):
        folder = tmp_path_factory.mktemp("tables")
        for name, frame in frames.items():
            frame.write.parquet(str(folder / f"{name}.parquet"))
        return str(folder)

    return write
