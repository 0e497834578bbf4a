"""Frequencies, modes and distinct counts of categorical columns.

Counting by value combines on the map side, so a value that fills a third of the table reaches the
shuffle as one partial count per task. Modes do not count all values: a mergeable counter
summary names the few that can be the most frequent, and only these are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import column
from chartloom.operators.roles import text_columns
from chartloom.plans.staging import spread

TRACKED = 1_000  # values that a summary keeps of a column
ERROR = 3.5 / 2_048  # of all rows: what a summary of that size can miss of a value's count at most
SURELY_HELD = TRACKED // 2  # estimated values of a column that surely fit a summary
NAMED = 100  # candidates that are counted
SHORT = 64  # bytes of a value that a summary keeps as it is; others are hashed
PARTS = 64  # summaries of a column that are merged first
FEW_TIES = 1_000_000  # hashes of equally frequent values that are broadcast


def long_frequencies(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count of every value (null included) of every given column, as text."""
    names = text_columns(df) if columns is None else columns
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, n bigint")
    texts = df.select(*[column(name).cast("string").alias(name) for name in names])
    return (
        texts.unpivot([], [column(name) for name in names], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequencies(df: DataFrame, name: str) -> DataFrame:
    """Count of every value of one column, nulls left out, in no order."""
    value = column(name)
    return (
        df.where(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Frequency table, most frequent first; equal counts by value."""
    return frequencies(df, name).orderBy(F.desc("n"), "value")


def _cells(df: DataFrame, names: list[str]) -> DataFrame:
    """(i, value, key) of every cell with a value: ``key`` is the value, or its hash if it is long."""
    listed = ", ".join("cast(`" + name.replace("`", "``") + "` as string)" for name in names)
    value = F.col("value")
    key = F.when(F.octet_length(value) <= SHORT, F.concat(F.lit("="), value)).otherwise(
        F.concat(F.lit("#"), F.hex(F.xxhash64(value)))
    )
    return df.selectExpr(f"posexplode(array({listed})) as (i, value)").where("value is not null").withColumn("key", key)


def _leading(cells: DataFrame) -> dict[int, tuple[int, bool, list[tuple[str, int]]]]:
    """By column: rows, whether all values are counted, and the leading keys with their counts (at least the true ones)."""
    part = (F.spark_partition_id() % PARTS).alias("part")
    states = cells.groupBy("i", part).agg(
        F.call_function("approx_top_k_accumulate", "key", F.lit(TRACKED)).alias("state"),
        F.hll_sketch_agg("key").alias("values"),
        F.count(F.lit(1)).alias("n"),
    )
    merged = states.groupBy("i").agg(
        F.call_function("approx_top_k_combine", "state", F.lit(TRACKED)).alias("state"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("values"),
        F.sum("n").alias("n"),
    )
    top = merged.select("i", "n", "values", F.call_function("approx_top_k_estimate", "state", F.lit(NAMED)).alias("top"))
    return {
        row["i"]: (row["n"], row["values"] <= SURELY_HELD, [(t["item"], t["count"]) for t in row["top"]])
        for row in top.collect()
    }


def _counted(cells: DataFrame, candidates: list[tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """The most frequent of the candidates by column, counted by value."""
    keys = cells.sparkSession.createDataFrame(candidates, "i int, key string")
    counted = cells.join(F.broadcast(keys), ["i", "key"]).groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("i").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
    return {row["i"]: (-row["best"]["rank"], row["best"]["value"]) for row in best.collect()}


def _counted_by_hash(cells: DataFrame, columns: list[int]) -> dict[int, tuple[int, str]]:
    """The same over all values: hashes are shuffled, and texts only of those that tie for the most."""
    hashed = cells.where(F.col("i").isin(*columns)).select("i", F.xxhash64("value").alias("hash"), "value")
    counts = hashed.groupBy("i", "hash").agg(F.count(F.lit(1)).alias("n"))
    most = {row["i"]: row["n"] for row in counts.groupBy("i").agg(F.max("n").alias("n")).collect()}
    found = {}
    # Where no value comes twice, all of them tie, and the least is a plain minimum.
    single = [i for i, n in most.items() if n == 1]
    if single:
        least = hashed.where(F.col("i").isin(*single)).groupBy("i").agg(F.min("value").alias("value"))
        found.update({row["i"]: (1, row["value"]) for row in least.collect()})
    several = {i: n for i, n in most.items() if n > 1}
    if several:
        wanted = cells.sparkSession.createDataFrame(list(several.items()), "i int, n long")
        ties = counts.join(F.broadcast(wanted), ["i", "n"]).select("i", "hash")
        few = ties.limit(FEW_TIES + 1).count() <= FEW_TIES
        least = hashed.join(F.broadcast(ties) if few else ties, ["i", "hash"], "left_semi").groupBy("i").agg(
            F.min("value").alias("value")
        )
        found.update({row["i"]: (several[row["i"]], row["value"]) for row in least.collect()})
    return found


def modes(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value, n): most frequent value per column, the smallest one on a tie.

    One pass summarises every column by at most ``TRACKED`` counters. A summary that never overflowed
    has all counts; else the values it names are counted in a second pass, and the best of them is right if
    its count is beyond what the summary can have missed (twice its error, for values it does not name). Where
    it is not, hence no value is frequent, all values are counted by hash.
    """
    names = text_columns(df) if columns is None else columns
    schema = "column string, value string, n bigint"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    cells = _cells(spread(df.select(*[column(name) for name in names])), names)
    leading = _leading(cells)
    found: dict[int, tuple[int, str]] = {}
    asked: list[tuple[int, str]] = []
    for i, (_, complete, top) in leading.items():
        most = max((n for _, n in top), default=0)
        ties = [key for key, n in top if n == most]
        complete = complete and (len(top) < NAMED or top[-1][1] < most)
        if complete and all(key.startswith("=") for key in ties):
            found[i] = most, min(ties, key=str.encode)[1:]
        else:
            asked += [(i, key) for key, _ in top]
    if asked:
        for i, (most, value) in _counted(cells, asked).items():
            n, complete, top = leading[i]
            named = len(top) < NAMED or top[-1][1] < most
            if named and (complete or most > 2 * ERROR * n):
                found[i] = most, value
    left = sorted(set(leading) - set(found))
    if left:
        found.update(_counted_by_hash(cells, left))
    return df.sparkSession.createDataFrame([(names[i], value, n) for i, (n, value) in sorted(found.items())], schema)


def distinct_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Exact number of distinct non-null values per column."""
    return (
        long_frequencies(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("n_distinct"))
    )


def low_cardinality(df: DataFrame, columns: list[str], below: int) -> dict[str, int]:
    """Exact distinct count of the columns with fewer than ``below`` values.

    A sketch of every column comes first, in one scan and without a shuffle of values.
    Below its counting threshold a sketch cannot report more values than there are
    (beyond rounding), so a column it puts above the limit is out for certain. Only
    the rest, whose value sets are tiny, are counted exactly.
    """
    if not columns:
        return {}
    sketch = df.agg(
        *[F.approx_count_distinct(column(name)).alias(f"d{i}") for i, name in enumerate(columns)]
    ).first()
    candidates = [name for i, name in enumerate(columns) if sketch[f"d{i}"] <= below]
    if not candidates:
        return {}
    exact = {r["column"]: r["n_distinct"] for r in distinct_counts(df, candidates).collect()}
    return {name: exact.get(name, 0) for name in candidates if exact.get(name, 0) < below}
