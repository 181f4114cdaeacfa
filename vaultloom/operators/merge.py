"""Merges expressed as joins: upsert, insert-only, and replace-a-batch.

A target of ``None`` means that the table does not exist yet. The source must
hold a key at most once (``quality.merge_ambiguity`` finds offenders) and no
NULL in its key, since NULL matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultloom.functions.text import literal
from vaultloom.operators.dedup import anti_join_null_safe, merged, not_among


def audit_columns(load_dttm: str, load_src: str) -> list[str]:
    """SQL text of the audit pair; both come from the job's parameters."""
    return [f"TIMESTAMP_NTZ'{load_dttm}' AS load_dttm", f"{literal(load_src)} AS load_src"]


def kept_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Keys of the target that the source does not hold; keys alone are moved, of both sides."""
    if null_safe:
        return anti_join_null_safe(target.select(*keys), merged(source), keys)
    return not_among(target.select(*keys), source, keys)


def merge_upsert(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], null_safe: bool = False,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Source rows, plus the target rows whose key the source does not hold.

    Only the source's keys meet the target; its wide rows pass by the join. With
    ``null_safe`` a NULL key part matches NULL. ``kept`` may be the written result of
    :func:`kept_keys`: a drop that holds most keys again leaves few, whose size is then
    known; the planner broadcasts them, and the target's wide rows are not shuffled either.
    """
    if target is None:
        return source
    if kept is not None:
        same = " AND ".join(f"old.{k} <=> kept.{k}" for k in keys)  # a NULL that was kept, too
        kept = target.alias("old").join(kept.alias("kept"), F.expr(same), "left_semi")
    elif null_safe:
        kept = anti_join_null_safe(target, source, keys)
    else:
        kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*source.columns).unionByName(source)


def merge_placed(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``merge_upsert`` for a target that lies in buckets of its key.

    The source is dealt by the key into as many partitions as there are buckets (see
    ``Warehouse.placed``). Every row then meets its partner in the bucket's task, and a
    write to the same buckets needs no exchange: the target is never moved, the source once.
    """
    columns, new = source.columns, "merge_new"
    same = F.expr(" AND ".join(f"old.{k} = new.{k}" for k in keys))
    met = target.select(*columns).alias("old").join(
        source.withColumn(new, F.lit(True)).alias("new"), same, "full_outer")
    return met.selectExpr(*[f"CASE WHEN new.{new} THEN new.{c} ELSE old.{c} END AS {c}" for c in columns])


def new_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key the target does not hold: the delta to append."""
    if target is None:
        return source
    return not_among(source, target, keys)


def merge_insert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus new keys; matched rows stay as they are."""
    if target is None:
        return source
    return target.select(*source.columns).unionByName(new_rows(target, source, keys))


def replace_batch(target: DataFrame | None, batch: DataFrame, column: str, value: str) -> DataFrame:
    """Append a batch under its own label; loading the same label again replaces it."""
    labelled = batch.withColumn(column, F.lit(value))
    if target is None:
        return labelled
    others = target.filter(~F.col(column).eqNullSafe(F.lit(value)))
    return others.select(*labelled.columns).unionByName(labelled)
