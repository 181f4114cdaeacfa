"""Close-and-insert history (slowly changing dimension, type 2).

A row is open while ``valid_to`` is NULL. One full outer join of the target with
the source on the key yields, per pair, the old row (closed if it changed) and
the new open row, so both sides are read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CLOSE_OPEN_ONLY = "open_only"
CLOSE_ALL_DIFFERING = "all_differing"


def _differs(values: Sequence[str]) -> str:
    """True where a value changed; a comparison with NULL is never a change."""
    return " OR ".join(f"coalesce(old.{v} <> new.{v}, false)" for v in values)


def _same_key(keys: Sequence[str]):
    return F.expr(" AND ".join(f"old.{k} = new.{k}" for k in keys))


def first_load(source: DataFrame, load_ts: str) -> DataFrame:
    """The history of a table that does not exist yet: every row open."""
    return source.selectExpr(
        "*", f"TIMESTAMP_NTZ'{load_ts}' AS valid_from",
        "cast(NULL AS timestamp_ntz) AS valid_to")


def close_and_insert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    load_ts: str,
    close: str = CLOSE_OPEN_ONLY,
) -> DataFrame:
    """History after one load.

    ``source`` holds one row per key with the value and audit columns. Keys that
    it lacks stay open. ``open_only`` closes the open row of a changed key;
    ``all_differing`` also moves ``valid_to`` of closed rows that differ from the
    source, on every load. In ``open_only`` mode the target may be given without
    its closed rows: see :func:`open_rows`.
    """
    if close not in (CLOSE_OPEN_ONLY, CLOSE_ALL_DIFFERING):
        raise ValueError(f"unknown close mode {close!r}")
    opened = first_load(source, load_ts)
    if target is None:
        return opened
    columns = opened.columns
    if close == CLOSE_OPEN_ONLY:
        closed = target.filter("valid_to IS NOT NULL").select(*columns)
        return closed.unionByName(advance(open_rows(target), source, keys, values, load_ts))
    return advance(target, source, keys, values, load_ts, close)


def open_rows(target: DataFrame) -> DataFrame:
    return target.filter("valid_to IS NULL")


def advance(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    load_ts: str,
    close: str = CLOSE_OPEN_ONLY,
) -> DataFrame:
    """The given target rows and the source, joined and brought to ``load_ts``.

    Where both lie in partitions of the key, as the open rows of a bucketed history and a
    placed source do, nothing is moved, and the result lies in them too.
    """
    opened = first_load(source, load_ts)
    columns = opened.columns
    joined = target.select(*columns).alias("old").join(
        opened.alias("new"), _same_key(keys), "full_outer")

    known, is_open = f"old.{keys[0]} IS NOT NULL", "old.valid_to IS NULL"
    differs = f"({_differs(values)})"
    changed = f"{differs} AND {is_open}"
    closes = changed if close == CLOSE_OPEN_ONLY else differs
    valid_to = f"CASE WHEN {closes} THEN TIMESTAMP_NTZ'{load_ts}' ELSE old.valid_to END"

    fixed = [c for c in columns if c != "valid_to"]
    old_row = ", ".join([*[f"'{c}', old.{c}" for c in fixed], f"'valid_to', {valid_to}"])
    new_row = ", ".join([*[f"'{c}', new.{c}" for c in fixed], "'valid_to', new.valid_to"])
    old_row, new_row = f"named_struct({old_row})", f"named_struct({new_row})"
    rows = (
        f"CASE WHEN {known} AND {changed} THEN array({old_row}, {new_row}) "
        f"WHEN {known} THEN array({old_row}) ELSE array({new_row}) END"
    )
    return joined.selectExpr(f"inline({rows})").select(*columns)


def changed_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Source rows whose value differs from the open target row of their key."""
    new, old = source.alias("new"), open_rows(target).alias("old")
    return new.join(old, _same_key(keys)).filter(_differs(values)).select("new.*")


def splice(
    target: DataFrame, late: DataFrame, later: DataFrame, keys: Sequence[str], values: Sequence[str], late_ts: str
) -> DataFrame:
    """The history as if a drop that came late had been loaded in its turn.

    ``target`` is the whole history without that drop. ``late`` holds the drop's rows, one
    per key, with value and audit columns; ``later`` the first load after ``late_ts`` that
    delivered a key again, as (keys, ``seen_ts``, ``seen_src``), no row where none did.

    A history is a list of points at which a value begins. The late value begins at
    ``late_ts``; what held before begins again at ``seen_ts``, if the key came again and
    said the same; points that change nothing go, and each row ends where the next begins.
    Rows of keys that the late drop lacks stay as they are.

    All three sides meet in one exchange by key and are sorted there, so a task holds what
    its partition does and can spill. No side is broadcast: a drop's keys take many times
    their size in files, in every task. A window holds one key's history.
    """
    opened = first_load(late, late_ts)
    columns = [c for c in opened.columns if c not in keys and c != "valid_to"]
    at, known = f"TIMESTAMP_NTZ'{late_ts}'", " AND ".join(f"{k} IS NOT NULL" for k in keys)
    seen = later.filter(known).select(*keys, F.struct("seen_ts", "seen_src").alias("seen"))
    rows = target.select(*opened.columns).withColumn("is_late", F.lit(False)).unionByName(
        opened.withColumn("is_late", F.lit(True))).unionByName(seen, allowMissingColumns=True)
    of_key = Window.partitionBy(*keys)
    met = rows.select(
        "*", F.max("is_late").over(of_key).alias("came_late"), F.collect_list("seen").over(of_key).alias("again"))
    met = met.filter("is_late IS NOT NULL").withColumn("touched", F.expr(f"is_late OR (came_late AND {known})"))
    spans = f"touched AND NOT is_late AND valid_from <= {at} AND coalesce(valid_to > s.seen_ts, true)"
    renamed = {"valid_from": "s.seen_ts", "load_dttm": "s.seen_ts", "load_src": "s.seen_src"}
    row = ", ".join(f"'{c}', {c}" for c in [*columns, "valid_to"])
    begun = ", ".join([*[f"'{c}', {renamed.get(c, c)}" for c in columns], "'valid_to', valid_to"])
    points = met.selectExpr(  # the keys stay outside, so that rows stay where they are
        *keys, "touched",
        f"inline(concat(array(named_struct({row})), transform(filter(again, s -> {spans}), s -> named_struct({begun}))))")
    order = Window.partitionBy(*keys, "touched").orderBy("valid_from")
    new, old = F.struct(*values).alias("new"), F.lag(F.struct(*values)).over(order).alias("old")
    changes = points.select("*", new, old).filter(f"NOT touched OR old IS NULL OR {_differs(values)}")
    ends = F.when(F.col("touched"), F.lead("valid_from").over(order)).otherwise(F.col("valid_to"))
    return changes.withColumn("valid_to", ends).select(*opened.columns)
