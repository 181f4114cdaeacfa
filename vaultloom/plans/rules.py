"""Every rule that the tables declare, counted over rows to which none was applied.

The result has one row per rule: (table_name, rule, column_name, violations). NULL and
length rules of a table take one scan together. Keys and references are folded before
they meet anything, so hot values stay in their tasks; rows that a job folds are written
once for all its rules.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultloom.operators import quality
from vaultloom.plans import staging, vault
from vaultloom.sources.tables import TABLES


def counted(
    feeds: Mapping[str, DataFrame], hubs: Mapping[str, DataFrame], keep: vault.Keep | None = None
) -> DataFrame:
    """Violations of all tables; ``feeds`` are prepared rows by staging table, read often.
    ``keep`` may write folded rows under a name and read them back."""
    found = []
    for table in staging.STAGING_TABLES:
        found += _staging_rules(table, feeds[table])
    for job in vault.JOBS.values():
        found += _vault_rules(job, feeds[job.source], hubs, keep)
    return reduce(DataFrame.unionByName, found)


def _staging_rules(table: str, prepared: DataFrame) -> list[DataFrame]:
    t, rows = TABLES[table], staging.conform(table, prepared)
    nulls = {c: f"{c} IS NULL" for c in t.required}
    lengths = {c: f"octet_length({c}) > {n}" for c, n in t.max_bytes.items()}
    return [_cells(table, rows, nulls, lengths), _keys(table, rows)]


def _vault_rules(
    job: vault.Job, prepared: DataFrame, hubs: Mapping[str, DataFrame], keep: vault.Keep | None = None
) -> list[DataFrame]:
    t = TABLES[job.table]
    rows = vault.business_rows(job, staging.conform(job.source, prepared), keep, complete=False)
    nulls = {c: _missing(ref) for c, ref in job.refs.items()}
    nulls.update({c: f"{source} IS NULL" for c, source in job.values.items()})
    lengths = {
        c: f"octet_length({job.values[c]}) > {n}" for c, n in t.max_bytes.items() if c in job.values}
    finished = vault.finished_rows(job, rows, "2000-01-01 00:00:00", "")
    found = [
        _cells(t.name, rows, {c: n for c, n in nulls.items() if c in t.required}, lengths),
        _keys(t.name, finished)]
    for column in t.parents:
        ref = job.refs[column]
        known = rows if ref.nullable else quality.complete_rows(rows, ref.columns)
        found.append(_total(vault.orphans(job, known, column, hubs), t.name, "parent", column))
    return found


def _missing(ref: vault.Ref) -> str:
    return "false" if ref.nullable else " OR ".join(f"{c} IS NULL" for c in ref.columns)


def _cells(table: str, rows: DataFrame, nulls: Mapping[str, str], lengths: Mapping[str, str]) -> DataFrame:
    rules = [("null", c, broken) for c, broken in nulls.items()]
    rules += [("length", c, broken) for c, broken in lengths.items()]
    sums = rows.agg(*[F.count_if(F.expr(broken)).alias(f"n{i}") for i, (_, _, broken) in enumerate(rules)])
    each = ", ".join(
        f"named_struct('table_name', '{table}', 'rule', '{rule}', 'column_name', '{c}', 'violations', n{i})"
        for i, (rule, c, _) in enumerate(rules))
    return sums.selectExpr(f"inline(array({each}))")


def _keys(table: str, rows: DataFrame) -> DataFrame:
    key = TABLES[table].key
    return _total(quality.key_violations(rows, key), table, "key", ",".join(key))


def _total(violations: DataFrame, table: str, rule: str, column: str) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).selectExpr(
        f"'{table}' AS table_name", f"'{rule}' AS rule", f"'{column}' AS column_name", "violations")
