"""Last write wins per record key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, key: str, order: str, within: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``order`` per key (and per value of ``within``).

    ``max_by`` keeps one row per key before the shuffle already, so a key that holds a third of all rows sends one
    row per task.
    """
    rest = [c for c in df.columns if c != key and c not in within]
    best = df.groupBy(*within, key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__last"))
    return best.select(*[F.col(f"__last.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def write_errors(df: DataFrame, reason: str, limit: int = 50) -> DataFrame:
    """The first failed records of a commit, for its log."""
    return df.where(F.col(reason).isNotNull()).limit(limit)


def commit_check(df: DataFrame, reason: str) -> DataFrame:
    """One row: total and failed records of a commit."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(reason).alias("errors"))
