"""Declared constraints as jobs: each returns the rows or keys that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultloom.operators.dedup import not_among


class LoadError(Exception):
    """A load broke one of its rules; nothing was published."""


def expect_none(violations: DataFrame, rule: str) -> None:
    few = violations.limit(3).collect()
    if few:
        raise LoadError(f"{rule}, e.g. {[row.asDict() for row in few]}")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key values held by more than one row, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def merge_ambiguity(source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Merge keys that several source rows share; such a merge has no one answer."""
    return key_violations(source if null_safe else complete_rows(source, keys), keys)


def any_null(columns: Sequence[str]) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns) or "false"


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a required column, naming the columns."""
    names = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in required)
    broken = df.filter(any_null(required))
    return broken.selectExpr("*", f"concat_ws(',', {names}) AS null_columns")


def complete_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows without a NULL in the columns; unlike ``dropna`` this reaches the scan."""
    if not required:
        return df
    return df.filter(" AND ".join(f"{c} IS NOT NULL" for c in required))


def orphan_keys(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of ``column`` with no parent row, each once.

    The distinct comes first: it folds hot values inside the tasks, so the rows
    that refer to one popular parent never meet in a single partition.
    """
    known = parent.select(F.col(parent_key).alias(column))
    return not_among(df.select(column).distinct(), known, [column])


def too_long(df: DataFrame, keys: Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """One row per text that needs more bytes than its column declares."""
    checks = ", ".join(
        f"named_struct('column_name', '{c}', 'bytes', octet_length({c}), 'max_bytes', {n})"
        for c, n in limits.items()
    )
    return df.selectExpr(*keys, f"inline(array({checks}))").filter("bytes > max_bytes")


def hash_collisions(df: DataFrame, key: str, business: Sequence[str]) -> DataFrame:
    """Hash keys that stand for several business keys.

    To be run on source and target together before a merge, which would
    overwrite the evidence.
    """
    pairs = df.select(key, *business).distinct()
    counted = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("business_keys"))
    return counted.filter("business_keys > 1")
