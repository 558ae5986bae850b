"""Sorts and shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sort_by(df: DataFrame, column: str, tiebreak: list[str] | None = None) -> DataFrame:
    """O1/O3: global sort by ``column`` then ``tiebreak`` (range partitions, so a hot
    value is spread over several partitions when the tiebreak differs)."""
    return df.orderBy(F.col(column), *[F.col(c) for c in (tiebreak or [])])


def shuffle_rows(df: DataFrame, seed: int, key_cols: list[str] | None = None) -> DataFrame:
    """A repeatable random order: sort by a seeded hash of the row's key."""
    cols = key_cols or df.columns
    return df.orderBy(F.xxhash64(*[F.col(c) for c in cols], F.lit(seed)), *[F.col(c) for c in cols])
