"""Price cleaning over files as they arrive.

Only row expressions are involved, so there is no state and no watermark. Sampling,
filling and profiles need the whole table and stay batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from chartloom.operators.price import clean_prices


def write_clean_prices(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Clean a stream of rows into Parquet files, until the present input is used up.

    A later run with the same checkpoint folder goes on where this one stopped.
    """
    return (
        clean_prices(rows)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
