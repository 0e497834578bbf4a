"""Batch entry point: clean the prices of a table and write a sample as one CSV file.

    python -m chartloom SOURCE TARGET [--rows N] [--seed S] [--key COLUMN [--unique-key]] [--format NAME]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from chartloom.operators.sample import SAMPLE_ROWS
from chartloom.plans.clean_sample import process_file


def main(arguments: list[str] | None = None) -> str:
    """Runs in the session that spark-submit or the environment configures; returns the target."""
    parser = argparse.ArgumentParser(prog="chartloom", description=__doc__.splitlines()[0])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--rows", type=int, default=SAMPLE_ROWS, help="size of the sample")
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--key", help="column that the sample's hash starts from")
    parser.add_argument("--unique-key", action="store_true", help="hash the key alone")
    parser.add_argument("--format", help="Spark data source, if the suffix does not tell")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("chartloom").getOrCreate()
    return process_file(
        spark, given.source, given.target, given.rows, given.seed, given.key, given.format, given.unique_key
    )


if __name__ == "__main__":
    print(main())
