"""Staging: each prepared feed is merged into its table on the table's key.

Geolocation merges on its full grain (zip, latitude, longitude), and payments
and order items on their natural keys, so that loading a drop twice changes
nothing. Rows that the feed no longer holds are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, TimestampNTZType

from vaultloom.operators.dedup import bounded
from vaultloom.operators.merge import kept_keys, merge_upsert
from vaultloom.operators.quality import any_null, complete_rows, null_violations
from vaultloom.sources.tables import STAGING, TABLES, tables_of

STAGING_TABLES = [t.name for t in tables_of(STAGING)]


def conform(table: str, prepared: DataFrame) -> DataFrame:
    """The table's columns by name, in its types; times are rounded to seconds."""
    return prepared.selectExpr(*[_typed(f) for f in TABLES[table].plain_schema])


def _typed(f: StructField) -> str:
    value = f.name
    if isinstance(f.dataType, TimestampNTZType):
        # Not date_trunc: it goes through the session's time zone, where some
        # local times do not exist.
        later = f"({f.name} + interval 500 milliseconds)"
        value = f"{later} - make_dt_interval(0, 0, 0, extract(SECOND FROM {later}) % 1)"
    return f"cast({value} as {f.dataType.simpleString()}) AS {f.name}"


def stage_rows(table: str, prepared: DataFrame) -> DataFrame:
    """What a drop contributes: conforming rows without a NULL that is forbidden."""
    return complete_rows(conform(table, prepared), TABLES[table].required)


def broken(table: str) -> str:
    """The condition on a prepared row under which staging leaves it out."""
    return any_null(TABLES[table].required)


def rejected_rows(table: str, prepared: DataFrame) -> DataFrame:
    """What staging leaves out, as (table, reason, row): rows with a forbidden NULL."""
    t = TABLES[table]
    broken = null_violations(conform(table, prepared), t.required)
    row = f"to_json(struct({', '.join(t.columns)}), map('ignoreNullFields', 'false')) AS row"
    return broken.selectExpr(
        f"'{table}' AS table_name", "concat('missing ', null_columns) AS reason", row)


def null_safe_key(table: str) -> bool:
    """Whether a part of the merge key may be NULL."""
    t = TABLES[table]
    return not set(t.key) <= set(t.required)


def load_staging(
    table: str, target: DataFrame | None, prepared: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """``keep`` may write the keys that the drop leaves out: see ``merge_upsert``."""
    rows, key, null_safe = stage_rows(table, prepared), TABLES[table].key, null_safe_key(table)
    kept = None
    if keep and target is not None:
        kept = bounded(keep(kept_keys(target, rows, key, null_safe), f"{table}.kept"))
    return merge_upsert(target, rows, key, null_safe, kept)
