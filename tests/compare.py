"""Runs a registered query and its SQL twin and compares the rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    ours = sorted_rows(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [field[0] for field in result.description]
    theirs = sorted_rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None
