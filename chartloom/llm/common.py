"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.plans.staging import file_system, shared_folder, staged

# Fixed values
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE_SPACE = " \t\n\u000b\f\r"

BROADCAST_ROWS = 1_000_000  # rows of a few numbers each: about 50 MB in a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(names: list[str]) -> list[Column]:
    """Columns by their exact names, dots and all."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def stage(df: DataFrame, name: str) -> DataFrame:
    """A copy in the shared folder that later passes scan: the lineage ends here."""
    return staged(df, f"{name}-{uuid.uuid4().hex}")


def stage_for_now(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """A copy in the shared folder, and a call that deletes it once nothing reads it any more."""
    spark, name = df.sparkSession, f"{name}-{uuid.uuid4().hex}"

    def discard() -> None:
        path = f"{shared_folder(spark)}/{name}"
        files, to_path = file_system(spark, path)
        files.delete(to_path(path), True)

    return staged(df, name), discard


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, text_bytes: int | None = None) -> DataFrame:
    """Mark a narrow table for broadcast if a count proves it small; else leave it to shuffle.

    Tables with texts, lists or structs give a bound of their bytes, too.
    """
    if text_bytes is None:
        return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
    plain = F.octet_length(F.to_json(F.struct(*every(df.columns))))
    found, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(plain), F.lit(0))).first()
    return F.broadcast(df) if found <= rows and size <= text_bytes else df


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and everything else as it was.

    ``lower`` does that for ASCII alone, and fast; other texts are mapped letter by letter.
    """
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_by_space(text: Column) -> Column:
    """Runs of characters other than space, tab, LF, VT, FF and CR; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def unit_hash(*parts: Column | str | int) -> Column:
    """A number in [0, 1), uniform over the parts: 52 bits of a hash of their text."""
    return hash_number(*parts, digits=13) / F.lit(float(16**13))


def hash_number(*parts: Column | str | int, digits: int = 15) -> Column:
    """The leading hexadecimal digits of an MD5 over the parts as a whole number."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")
