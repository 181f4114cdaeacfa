"""Drop-all-duplicates: keep only rows whose key occurs exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BROADCAST = 250_000
"""Rows of a set of keys that may be broadcast: some 30 MB in the driver and in every executor."""


def merged(side: DataFrame) -> DataFrame:
    """``side`` for a join that must not broadcast it, as nothing bounds its rows. The planner
    goes by the size of files, and keys take ten times as much and more once they are hashed."""
    return side.hint("merge")


def bounded(keys: DataFrame, rows: int | None = None) -> DataFrame:
    """Written keys for a join that leaves it to the planner whether few of them are broadcast,
    and sorts and merges many. ``rows``: how many they are, if that is known."""
    if rows is None:
        rows = keys.limit(MOST_BROADCAST + 1).count()
    return merged(keys) if rows > MOST_BROADCAST else keys


def not_among(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key the others, of any number, lack. An outer join, since the planner
    moves an anti join below the grouping that folded ``df``, onto every row."""
    held = merged(others.select(*keys).withColumn("is_held", F.lit(True)))
    return df.join(held, list(keys), "left").filter("is_held IS NULL").select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULLs count as equal.

    Only the key columns are read and shuffled, and the partial count folds a
    hot key to one row per task before the exchange.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def anti_join_null_safe(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among the others', NULLs being equal."""
    left, right = df.alias("this"), others.select(*keys).alias("other")
    same = " AND ".join(f"this.{k} <=> other.{k}" for k in keys)
    return left.join(right, F.expr(same), "left_anti")


def drop_all_duplicates(
    df: DataFrame, keys: Sequence[str], duplicates: DataFrame | None = None
) -> DataFrame:
    """Rows of ``df`` whose key is not among the duplicated ones.

    ``duplicates`` may be the written result of :func:`duplicate_keys`; its size
    is then known to the planner, which broadcasts it when it is small, so that
    the wide rows are not shuffled at all. A window count would instead move all
    copies of a hot key into one task.
    """
    if duplicates is None:
        duplicates = duplicate_keys(df, keys)
    return anti_join_null_safe(df, duplicates, keys)
