"""The ordered load: clean, stage, then hubs, links and satellites.

Jobs of one layer are independent and are submitted together; a layer starts
when the one before it is written. The first failure ends the load, and nothing
of it is published.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultloom.functions.keys import INT60
from vaultloom.operators import dedup, history, merge, quality
from vaultloom.operators.quality import LoadError
from vaultloom.operators.quality import expect_none as _expect_none
from vaultloom.plans import prep, staging, vault
from vaultloom.sources import csv_files
from vaultloom.sources.scratch import free_shuffles, scratch_folder, written
from vaultloom.sources.tables import HUB, RAW_FEEDS, TABLES
from vaultloom.sources.warehouse import LEDGER, PROVED, REJECTS, REJECTS_SCHEMA, Load, Warehouse

__all__ = ["LoadError", "Settings", "compact", "read_feeds", "read_prepared", "run_load", "write_prepared"]

FEED_FILES = {feed: f"{feed}.csv" for feed in RAW_FEEDS}
# Feeds with free text, which may hold line breaks. Such files cannot be split
# among tasks, so the others are read line by line.
MULTILINE_FEEDS = frozenset({"reviews"})
BROKEN = "broken"


@dataclass(frozen=True)
class Settings:
    load_ts: str
    load_src: str
    strict: bool = False  # enforce every declared rule and allow no rejects
    close: str = history.CLOSE_OPEN_ONLY
    first_seen: bool = False  # hubs keep the audit columns of a key's first load
    key: str = INT60  # or HEX128; a warehouse has one kind of key for good
    prove_once: bool = False  # keep the references that were proved; prove new ones only
    resume: bool = False  # go on with a failed attempt of this load; the feeds must be the same
    parallel_jobs: int = 8


def read_feeds(
    spark: SparkSession, folder: str, files: Mapping[str, str] = FEED_FILES
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(typed rows, rejects) of every raw CSV file of a folder.

    Each file is parsed once, into a table of typed cells in the scratch folder. Bad rows
    are counted in that write; a feed without any has no rejects in the result.
    """
    scratch = scratch_folder(spark)

    def scan(feed: str) -> tuple[DataFrame, DataFrame | None]:
        bad = Observation(feed)

        def keep(df: DataFrame) -> DataFrame:
            any_bad = F.count_if(F.col(csv_files.BAD_COLUMNS) != "").alias(BROKEN)
            return written(df.observe(bad, any_bad), scratch, feed)

        good, rejects = csv_files.csv_scan(
            spark, f"{folder}/{files[feed]}", RAW_FEEDS[feed], keep, multiline=feed in MULTILINE_FEEDS)
        return good, rejects if bad.get[BROKEN] else None

    with ThreadPoolExecutor(len(files)) as pool:
        scans = dict(zip(files, pool.map(scan, files), strict=True))
    return {f: s[0] for f, s in scans.items()}, {f: s[1] for f, s in scans.items() if s[1] is not None}


def write_prepared(prepared: Mapping[str, DataFrame], folder: str) -> None:
    """Prepared feeds as CSV folders, for tools that want files."""
    for feed, df in prepared.items():
        csv_files.write_csv(df, f"{folder}/{feed}")


def read_prepared(spark: SparkSession, folder: str) -> tuple[dict, dict]:
    """(good rows, rejects) of prepared CSV folders."""
    loads = {
        t: csv_files.typed_load(
            spark, f"{folder}/{t}", TABLES[t].plain_schema, multiline=t in MULTILINE_FEEDS)
        for t in staging.STAGING_TABLES
    }
    return {t: pair[0] for t, pair in loads.items()}, {t: pair[1] for t, pair in loads.items()}


def run_load(
    spark: SparkSession, warehouse: Warehouse, feeds: Mapping[str, DataFrame], settings: Settings,
    rejected: Mapping[str, DataFrame] | None = None,
) -> dict[str, int]:
    """Load one drop and publish it; returns the rows written per table.

    ``rejected`` are the raw rows that ``read_feeds`` could not type. They go to the
    rejects with what staging and the vault leave out.
    """
    resume = repr(replace(settings, parallel_jobs=0)) if settings.resume else None
    load = warehouse.begin(settings.load_ts, settings.key, resume)
    with ThreadPoolExecutor(settings.parallel_jobs) as pool:
        def each(work: Callable, items: Iterable) -> list:
            return list(pool.map(work, items))

        prepared = dict(each(lambda feed: (feed, _prepare(load, feeds, feed)), staging.STAGING_TABLES))
        each(lambda table: _stage(load, prepared[table], table, settings), staging.STAGING_TABLES)
        free_shuffles(spark)
        rejects = [_cells(feed, df) for feed, df in (rejected or {}).items()]
        rejects += [
            staging.rejected_rows(t, prepared[t]) for t in staging.STAGING_TABLES
            if load.counted(f"prepared.{t}", BROKEN)]
        for layer in vault.LAYERS:
            rejects += filter(None, each(lambda job: _load_job(load, job, settings), layer))
            free_shuffles(spark)
    _write_rejects(load, rejects, settings)
    load.commit()
    return load.row_counts


def _prepare(load: Load, feeds: Mapping[str, DataFrame], feed: str) -> DataFrame:
    raw, keys = feeds[feed], prep.DEDUP_KEYS.get(feed)
    duplicates = load.keep_keys(dedup.duplicate_keys(raw, keys), f"duplicates.{feed}") if keys else None
    translation = None
    if feed == "products":
        translation = load.keep(feeds["translation"], "translation")
        _expect_none(
            quality.merge_ambiguity(translation, prep.TRANSLATION_KEY),
            "translation: several rows share a category name")
    return load.keep(
        prep.prepare(feed, raw, translation, duplicates), f"prepared.{feed}", {BROKEN: staging.broken(feed)})


def _stage(load: Load, prepared: DataFrame, table: str, settings: Settings) -> None:
    if load.finished(table):
        return
    rows = staging.stage_rows(table, prepared)
    if settings.strict or table not in prep.DEDUP_KEYS:
        _expect_none(
            quality.merge_ambiguity(rows, TABLES[table].key, staging.null_safe_key(table)),
            f"{table}: several rows share a merge key")
    _upsert(load, table, rows, staging.null_safe_key(table))
    if not load.counted(f"prepared.{table}", BROKEN):  # else its rejects are read from it
        load.drop(f"prepared.{table}")


def _incomplete(table: str) -> dict[str, str]:
    """What to count while a staging table is written: rows that each of its jobs leaves out."""
    jobs = [job for job in vault.JOBS.values() if job.source == table]
    return {job.table: vault.incomplete(job) for job in jobs if vault.required_inputs(job)}


def _upsert(load: Load, table: str, source: DataFrame, null_safe: bool = False) -> None:
    """Merge into the table; a bucketed one stays where it is, and the source comes to it."""
    if load.warehouse.ranged(table):
        load.merge_changes(table, source)
        return
    target, key = load.target(table), TABLES[table].key
    if load.in_buckets(table):
        source = load.warehouse.placed(table, source)
        rows = source if target is None else merge.merge_placed(target, source, key)
        load.replace(table, rows, placed=True, counts=_incomplete(table))
    else:
        kept = None
        if target is not None and not load.finished(table):
            kept = load.keep_keys(merge.kept_keys(target, source, key, null_safe), f"{table}.kept")
        load.replace(table, merge.merge_upsert(target, source, key, null_safe, kept), counts=_incomplete(table))
        load.drop(f"{table}.kept")


def _load_job(load: Load, job: vault.Job, settings: Settings) -> DataFrame:
    staged = load.current(job.source)
    rows = vault.business_rows(job, staged, load.keep)
    parents = TABLES[job.table].parents
    checked = vault.checked_references(job, settings.strict)
    hubs = {parents[c]: load.current(parents[c]) for c in checked}
    if settings.prove_once:
        missing = {c: _unproved(load, job, rows, c, hubs[parents[c]], settings) for c in checked}
    else:
        missing = vault.missing_references(job, rows, hubs, settings.strict, load.keep_keys, settings.key)
    missing = {c: keys for c, keys in missing.items() if load.counted(f"{job.table}.{c}")}
    if not load.finished(job.table):
        source = vault.source_rows(job, rows, missing, settings.load_ts, settings.load_src, settings.key)
        _check_keys(job, source, settings)
        if TABLES[job.table].layer == HUB and vault.may_forget(job):
            _check_ledger(load, job, rows, settings)
        if settings.strict:
            _check_lengths(job, source)
        _merge(load, job, source, settings)
    load.drop(f"{job.table}.rows")
    counts = _incomplete(job.source)
    return vault.rejected_rows(job, staged, missing, job.table in counts and load.counted(job.source, job.table) > 0)


def _unproved(
    load: Load, job: vault.Job, rows: DataFrame, column: str, hub: DataFrame, settings: Settings
) -> DataFrame:
    """Orphan keys of a reference. A hub never loses an id, so what a load has proved stays
    so: only keys that no load has proved meet the hub, and what it holds of them is noted."""
    name = f"{PROVED}{job.table}_{column}"
    proved, keys = load.target(name), vault.reference_keys(job, rows, column, settings.key)
    if proved is not None:
        keys = dedup.not_among(keys, proved, ["id"])
    fresh = load.keep_keys(keys, f"{job.table}.{column}.fresh")
    columns = job.refs[column].columns
    if not load.counted(f"{job.table}.{column}.fresh"):
        load.carry(name)
        return load.keep_keys(fresh.select(*columns), f"{job.table}.{column}")
    held = load.keep_keys(vault.held_ids(fresh, hub), f"{job.table}.{column}.held")
    load.append(name, held)
    return load.keep_keys(fresh.join(held, "id", "left_anti").select(*columns), f"{job.table}.{column}")


def _merge(load: Load, job: vault.Job, source: DataFrame, settings: Settings) -> None:
    name, ts = job.table, settings.load_ts
    if job.mode == vault.HISTORY and settings.close == history.CLOSE_OPEN_ONLY:
        # Only open rows are read, once; what they turn into is appended as one folder.
        opened, placed = load.target(name), load.in_buckets(name)
        source = load.warehouse.placed(name, source) if placed else source
        rows = history.first_load(source, ts) if opened is None else history.advance(
            opened, source, list(job.refs), list(job.values), ts)
        load.append(name, rows.select(*TABLES[name].columns), placed=placed)
    elif job.mode == vault.HISTORY:
        whole = load.whole_target(name)
        load.replace(name, vault.load_table(job, whole, source, ts, settings.close))
    elif job.mode == vault.INSERT:
        load.append(name, merge.new_rows(load.target(name), source, TABLES[name].key))
    elif load.warehouse.ranged(name):
        _upsert(load, name, source)
    elif TABLES[name].layer == HUB and not settings.first_seen:
        load.replace(name, source)  # staging never loses a key, so no old row is missing
    elif TABLES[name].layer == HUB:
        load.replace(name, vault.load_table(job, load.target(name), source, ts, first_seen=True))
    else:
        _upsert(load, name, source)


def _check_keys(job: vault.Job, source: DataFrame, settings: Settings) -> None:
    """A hub's source holds each business key of staging once, old and new, so two rows
    with one id are a hash collision; that is looked for in every load."""
    table = TABLES[job.table]
    if table.layer == HUB:
        rule = "one id stands for several business keys"
    elif settings.strict:
        rule = "several rows share a key"
    else:
        return
    key = list(job.refs) if job.mode == vault.HISTORY else table.key
    _expect_none(quality.merge_ambiguity(source, key), f"{job.table}: {rule}")


def _check_ledger(load: Load, job: vault.Job, rows: DataFrame, settings: Settings) -> None:
    """Staging may have lost keys that the hub still stands for; their digests are kept
    in a ledger, so that a new key with the id of a lost one is seen before the merge."""
    name = LEDGER + job.table
    digests = load.keep(vault.key_digests(job, rows, settings.key), f"{job.table}.digests")
    before = load.target(name)
    if before is not None:
        known = dedup.merged(before.selectExpr("id", "digest AS known_digest"))
        _expect_none(
            digests.join(known, "id").filter("digest <> known_digest"),
            f"{job.table}: one id stands for several business keys")
    load.append(name, merge.new_rows(before, digests, ["id"]))


def _check_lengths(job: vault.Job, source: DataFrame) -> None:
    table = TABLES[job.table]
    key = list(job.refs) if job.mode == vault.HISTORY else table.key
    lengths = {c: n for c, n in table.max_bytes.items() if c in source.columns}
    _expect_none(quality.too_long(source, key, lengths), f"{job.table}: a text is too long")


def compact(warehouse: Warehouse) -> None:
    """Rewrite each growing table as one folder, under the newest load; maintenance, to be
    called between loads. Rows stay as they are."""
    newest = warehouse.snapshot()
    load = Load(warehouse, newest.load_id, newest, newest, newest.key)
    for name, folders in newest.tables.items():
        if len(folders) > 1:
            load.replace(name, warehouse.table(name, newest))
    load.commit()


def _cells(feed: str, rejected: DataFrame) -> DataFrame:
    cells = [c for c in rejected.columns if c not in ("bad_columns", "record")]
    if "record" in rejected.columns:
        cells.append("record")
    row = f"to_json(struct({', '.join(cells)}), map('ignoreNullFields', 'false')) AS row"
    return rejected.selectExpr(
        f"'{feed}' AS table_name", "concat('bad cells ', bad_columns) AS reason", row)


def _write_rejects(load: Load, rejects: list[DataFrame], settings: Settings) -> None:
    """Rejects are sought only where something was counted that would be one."""
    spark = load.warehouse.spark
    found = reduce(DataFrame.unionByName, rejects) if rejects else spark.createDataFrame([], REJECTS_SCHEMA)
    if settings.strict and rejects:
        _expect_none(found, "rows were rejected")
    load.replace(REJECTS, found)
