"""One row per key, chosen by an explicit position.

All three are plain aggregates, so Spark combines them before the shuffle and a key that
holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: str | Column, chooser, copies: str | None = None) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        chooser(F.struct(*others), F.col(order) if isinstance(order, str) else order).alias("row"),
        F.count(F.lit(1)).alias("copies"),
    )
    columns = [F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns]
    return picked.select(*columns, *([F.col("copies").alias(copies)] if copies else []))


def keep_last(df: DataFrame, keys: list[str], order: str | Column, copies: str | None = None) -> DataFrame:
    """Row with the greatest ``order`` value of every key (null keys form one key).

    ``copies`` optionally names a column with the number of rows the key had.
    """
    return _pick(df, keys, order, F.max_by, copies)


def keep_first(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """Row with the smallest ``order`` value of every key."""
    return _pick(df, keys, order, F.min_by)


def surplus_rows(df: DataFrame, keys: list[str] | None = None, name: str = "duplicates") -> DataFrame:
    """Number of rows beyond the first of their key, nulls being equal to each other."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def repeated_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
