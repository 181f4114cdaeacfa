"""Tables on disk, published load by load.

A load writes every table to a folder of its own and then appends one commit
record that names, per table, the folders it consists of. Readers use the newest
record, so a load becomes visible as a whole, and a failed or repeated load
leaves no trace in it. Nothing is read and overwritten in place.

- An upserted table is one folder, optionally bucketed by its key, so that the
  next merge does not shuffle it, neither to read nor to write it.
- With ``ranges``, an upserted table is split by a hash of its key, and each row has its
  range and a digest of its values beside it. A load compares digests and rewrites only the
  ranges that hold a changed or new row; audit columns then name the load that last changed
  the row. The table is a list of folders with the ranges that count in each. Ranges are no
  folders: files are sorted by range, so that a scan passes over those that do not count.
- An insert-only table is a list of folders; a load appends its delta.
- A history is a list of folders split by ``is_open``: open rows count in the
  last folder only, closed rows in all. A load reads and rewrites open rows, which
  are bucketed like an upserted table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from vaultloom.functions.keys import HEX128, INT60, hash_key, hex_key, key_inputs
from vaultloom.operators.dedup import anti_join_null_safe, bounded, merged
from vaultloom.sources.scratch import CODEC, written
from vaultloom.sources.tables import TABLES

_COMMIT = "load_id string, committed_ns bigint, tables map<string, array<string>>, key string"
SEGMENT, IS_OPEN = "segment", "is_open"
ROWS = "rows"
RANGE, DIGEST = "key_range", "row_digest"
AUDIT = ("load_dttm", "load_src")
REJECTS = "rejects"
REJECTS_SCHEMA = "table_name string, reason string, row string"
LEDGER = "keys_of_"
"""Before a hub's name: the ids it ever stood for, each with a digest of its business key."""
PROVED = "proved_of_"
"""Before a table's and a column's name: the ids that were found in the column's hub."""
KEY_TYPES = {INT60: LongType(), HEX128: StringType()}


_JOURNAL = "kind string, name string, paths array<string>, counts map<string, bigint>"
TABLE, KEPT, ATTEMPT = "table", "kept", "attempt"


def load_id(load_ts: str) -> str:
    """A load's place in the order of loads: its time, to the microsecond, in digits.

    The time is parsed, so that ``2024-1-2`` and ``2024-01-02`` are the same day.
    """
    for form in ("%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d"):
        try:
            return datetime.strptime(load_ts.strip().replace("T", " "), form).strftime("%Y%m%d%H%M%S%f")
        except ValueError:
            continue
    raise ValueError(f"not a load time: {load_ts!r}")


@dataclass(frozen=True)
class Snapshot:
    load_id: str = ""
    committed_ns: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    key: str = INT60


class Warehouse:
    """``buckets``: number of buckets of upserted tables; needs a catalog. ``ranges``: number
    of key ranges that are rewritten apart. One of both; each for all loads of a warehouse."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int | None = None, ranges: int | None = None
    ) -> None:
        if buckets and ranges:
            raise ValueError("buckets or ranges, not both")
        self.spark, self.root, self.buckets, self.ranges = spark, root.rstrip("/"), buckets, ranges

    def snapshot(self, before: str | None = None) -> Snapshot:
        """The newest committed state, or the newest older than load ``before``."""
        commits = self._commits()
        if commits is None:
            return Snapshot()
        if before:
            commits = commits.filter(F.col("load_id") < before)
        newest = commits.orderBy(F.desc("load_id"), F.desc("committed_ns")).limit(1).collect()
        if not newest:
            return Snapshot()
        return Snapshot(newest[0].load_id, newest[0].committed_ns, newest[0].tables, newest[0].key or INT60)

    def loaded(self) -> set[str]:
        """Ids of all committed loads; one short text per load."""
        commits = self._commits()
        return {r.load_id for r in commits.select("load_id").distinct().collect()} if commits else set()

    def _commits(self) -> DataFrame | None:
        files, path_of = self._files()
        if not files.exists(path_of(f"{self.root}/commits")):
            return None
        return self.spark.read.schema(_COMMIT).json(f"{self.root}/commits")

    def _files(self):
        """The file system of the warehouse, and its kind of path."""
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        return path_of(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path_of

    def table(self, name: str, snapshot: Snapshot | None = None) -> DataFrame:
        """A table as of a snapshot; empty before its first load."""
        state = snapshot or self.snapshot()
        paths = state.tables.get(name, [])
        if _is_history(name):
            return self.closed_rows(name, paths, state.key).unionByName(self.open_rows(name, paths, state.key))
        return self.read(name, paths, state.key)

    def read(self, name: str, paths: Sequence[str], key: str = INT60) -> DataFrame:
        schema = _schema(name, key)
        if not paths:
            return self.spark.createDataFrame([], schema)
        if self._in_buckets(name, paths[0]):
            return self.spark.table(self._registered(name, paths[0], schema))
        if _folder_of(paths[0]) != paths[0]:
            return self.range_rows(name, paths, key).select(*schema.names)
        return self.spark.read.schema(schema).parquet(*paths)

    def range_rows(self, name: str, paths: Sequence[str], key: str = INT60) -> DataFrame:
        """Rows of a table of key ranges with range and digest; of each folder, the ranges that count."""
        schema = _schema(name, key)
        split = StructType([*schema.fields, StructField(DIGEST, StringType()), StructField(RANGE, IntegerType())])
        return reduce(DataFrame.unionByName, [
            self.spark.read.schema(split).parquet(_folder_of(p)).filter(F.col(RANGE).isin(sorted(_ranges(p))))
            for p in paths])

    def open_rows(self, name: str, paths: Sequence[str], key: str = INT60) -> DataFrame:
        return self._part(name, paths[-1:], IS_OPEN, key)

    def closed_rows(self, name: str, paths: Sequence[str], key: str = INT60) -> DataFrame:
        return self._part(name, paths, f"NOT {IS_OPEN}", key)

    def _part(self, name: str, paths: Sequence[str], which: str, key: str) -> DataFrame:
        schema = _schema(name, key)
        if not paths:
            return self.spark.createDataFrame([], schema)
        if which == IS_OPEN and self._in_buckets(name, paths[-1]):
            opened = self.spark.table(self._registered(name, paths[-1], schema)).filter(which)
            return opened.select(*schema.names)
        split = StructType([
            *schema.fields, StructField(SEGMENT, StringType()), StructField(IS_OPEN, BooleanType())])
        rows = self.spark.read.schema(split).option("basePath", self._folder(name)).parquet(*paths)
        return rows.filter(which).drop(SEGMENT, IS_OPEN)

    def _folder(self, name: str) -> str:
        return f"{self.root}/data/{name}"

    def bucketed(self, name: str) -> bool:
        t = TABLES.get(name)
        return bool(self.buckets and t and t.name not in INSERT_ONLY and set(t.key) <= set(t.required))

    def _in_buckets(self, name: str, path: str) -> bool:
        """Whether the folder was written in as many buckets as this warehouse has."""
        return self.bucketed(name) and path.endswith(f"_{self.buckets}b")

    def ranged(self, name: str) -> bool:
        return bool(self.ranges and name in TABLES and name not in INSERT_ONLY and not _is_history(name))

    def marked(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows with their key range and the digest of their values."""
        t = TABLES[name]
        values = [c for c in t.columns if c not in (*t.key, *AUDIT)]
        key = hash_key(*key_inputs(rows.schema, t.key), digits=4)
        return rows.selectExpr(
            *t.columns, f"cast({key} % {self.ranges} AS int) AS {RANGE}",
            f"{hex_key(*key_inputs(rows.schema, values))} AS {DIGEST}")

    def ranges_of(self, name: str, load_id: str, state: Snapshot | None = None) -> int:
        """How many ranges of a table a load has written."""
        paths = (state or self.snapshot()).tables.get(name, [])
        return sum(len(_ranges(p)) for p in paths if _folder_of(p).rsplit("/", 1)[1].startswith(load_id))

    def placed(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows of a bucketed table in as many partitions, by the hash that buckets have."""
        return rows.repartition(self.buckets, *_bucket_key(name)) if self.bucketed(name) else rows

    def _registered(self, name: str, path: str, schema: StructType) -> str:
        """The catalog name of a bucketed folder, registered if this catalog lacks it."""
        table = f"{name}_{path.rsplit('/', 1)[1].removeprefix(f'{SEGMENT}=')}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            key, split = ", ".join(_bucket_key(name)), ""
            if _is_history(name):
                columns, split = f"{columns}, {IS_OPEN} boolean", f"PARTITIONED BY ({IS_OPEN}) "
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet {split}CLUSTERED BY ({key}) "
                f"SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
            if split:
                self.spark.catalog.recoverPartitions(table)
        return table

    def remove_superseded(self, keep_loads: int = 2, attempts: bool = False) -> list[str]:
        """Delete what no commit of the newest ``keep_loads`` loads names: table folders, their
        catalog entries, and intermediate tables. Returns the deleted folders.

        Two loads at least, so that the newest can be repeated. Folders of the newest load and
        of one that still runs are left alone; readers of older states lose them. ``attempts``:
        of the newest load, too, what only a commit names that the load has replaced by repeating.
        """
        if keep_loads < 2:
            raise ValueError("keep two loads at least")
        newest = self.snapshot().load_id
        if not newest:
            return []
        commits = self.spark.read.schema(_COMMIT).json(f"{self.root}/commits")
        kept = (commits.groupBy("load_id").agg(F.max_by("tables", "committed_ns").alias("tables"))
                .orderBy(F.desc("load_id")).limit(keep_loads).collect())
        named = _named(kept)
        replaced = _named(commits.filter(F.col("load_id") == newest).collect()) - named if attempts else set()
        files, path_of = self._files()

        def folders(path: str) -> list[str]:
            at = path_of(path)
            return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []

        def older(folder: str) -> bool:
            return folder.removeprefix(f"{SEGMENT}=").split("_")[0] < newest

        gone = [f"{self.root}/{kind}/{f}" for kind in ("scratch", "journal")
                for f in folders(f"{self.root}/{kind}") if older(f)]
        for name in folders(f"{self.root}/data"):
            for folder in folders(self._folder(name)):
                if (older(folder) and (name, folder) not in named) or (name, folder) in replaced:
                    if folder.endswith("b"):
                        self.spark.sql(f"DROP TABLE IF EXISTS {name}_{folder.removeprefix(f'{SEGMENT}=')}")
                    gone.append(f"{self._folder(name)}/{folder}")
        for path in gone:
            files.delete(path_of(path), True)
        return gone

    def written_ranges(self, path: str) -> list[int]:
        """The ranges of which a folder has rows, at most ``ranges`` numbers."""
        found = self.spark.read.schema(f"{RANGE} int").parquet(path).distinct().collect()
        return sorted(r[0] for r in found)

    def begin(self, load_ts: str, key: str = INT60, resume: str | None = None) -> Load:
        """A load at ``load_ts``; one writer at a time, which ``commit`` checks. A warehouse
        whose loads have another kind of ``key`` refuses it.

        ``resume``: keep a journal of what is written, and go on with a failed attempt that
        had the same text here and began from the same state, where there is one.
        """
        if key not in KEY_TYPES:
            raise ValueError(f"unknown kind of key {key!r}")
        this, newest = load_id(load_ts), self.snapshot()
        if newest.load_id and newest.key != key:
            raise ValueError(f"this warehouse has keys of kind {newest.key}, not {key}")
        if this < newest.load_id:
            raise ValueError(f"load {load_ts} is older than the newest committed load")
        load = Load(self, this, self.snapshot(before=this), newest, key)
        if resume is not None:
            load.keep_journal(f"{resume} on {newest.load_id} {newest.committed_ns}")
        return load

    def attempts(self, load_id: str, what: str) -> list[str]:
        """Unfinished attempts of a load that keep a journal under ``what``, the oldest first."""
        files, path_of = self._files()
        folder = path_of(f"{self.root}/journal")
        found = files.listStatus(folder) if files.exists(folder) else []
        named = sorted((f.getModificationTime(), f.getPath().getName()) for f in found)
        return [name.rsplit("_", 1)[1] for _, name in named if name.startswith(f"{load_id}_")
                and any(e.kind == ATTEMPT and e.name == what for e in self.journal(name))]

    def journal(self, name: str) -> list:
        """What an attempt has written: a line for each table and intermediate table."""
        return self.spark.read.schema(_JOURNAL).json(f"{self.root}/journal/{name}").collect()


class Load:
    """One load: reads the state before it, writes new folders, commits at the end.

    Repeating a load starts again from the state before it and replaces it. With a journal
    (see ``Warehouse.begin``) an attempt that failed is taken up where it ended.
    """

    def __init__(
        self, warehouse: Warehouse, load_id: str, base: Snapshot, newest: Snapshot, key: str = INT60
    ) -> None:
        self.warehouse, self.load_id, self.base, self._newest = warehouse, load_id, base, newest
        self.key = key
        self._attempt = uuid.uuid4().hex[:12]
        self._journal: str | None = None
        self._written: dict[tuple[str, str], list[str]] = {}
        self._new: dict[str, list[str]] = {}
        self.row_counts: dict[str, int] = {}
        self._counted: dict[tuple[str, str], int] = {}

    @property
    def _scratch(self) -> str:
        return f"{self.warehouse.root}/scratch/{self.load_id}_{self._attempt}"

    def keep_journal(self, what: str) -> None:
        """Note what is written from now on; take over what an earlier attempt noted."""
        found = self.warehouse.attempts(self.load_id, what)
        if found:
            self._attempt = found[-1]
            for entry in self.warehouse.journal(f"{self.load_id}_{self._attempt}"):
                self._written[entry.kind, entry.name] = entry.paths
                self._counted.update({(entry.name, what): n for what, n in (entry.counts or {}).items()})
        self._journal = f"{self.warehouse.root}/journal/{self.load_id}_{self._attempt}"
        if not found:
            self._enter(ATTEMPT, what, [])

    def _enter(self, kind: str, name: str, paths: list[str]) -> None:
        """A line of the journal, as a file of its own that appears whole."""
        if self._journal is None:
            return
        counts = {what: n for (of, what), n in self._counted.items() if of == name}
        line = json.dumps({"kind": kind, "name": name, "paths": paths, "counts": counts})
        files, path_of = self.warehouse._files()
        at = f"{self._journal}/{uuid.uuid4().hex}.json"
        out = files.create(path_of(f"{at}._part"))
        out.write(line.encode())
        out.close()
        files.rename(path_of(f"{at}._part"), path_of(at))

    def finished(self, name: str) -> bool:
        """Whether an earlier attempt has written the table; it then counts as written."""
        paths = self._written.get((TABLE, name))
        if paths is None:
            return False
        self._new[name], self.row_counts[name] = paths, self._counted.get((name, ROWS), 0)
        return True

    def keep(self, df: DataFrame, name: str, counts: Mapping[str, str] | None = None) -> DataFrame:
        """An intermediate result as a written table. Its rows are counted in the same write,
        and so are those that meet each condition of ``counts``."""
        if (KEPT, name) in self._written:
            return self.warehouse.spark.read.schema(df.schema).parquet(f"{self._scratch}/{name}")
        seen, df = _observed(df, name, counts)
        kept = written(df, self._scratch, name, CODEC)
        self._note(name, seen)
        self._enter(KEPT, name, [])
        return kept

    def keep_keys(self, keys: DataFrame, name: str) -> DataFrame:
        """The same for keys that others are looked up in; many of them are never broadcast."""
        kept = self.keep(keys, name)
        return bounded(kept, self.counted(name))

    def drop(self, name: str) -> None:
        """Delete an intermediate result that nothing reads any more; with a journal it stays,
        for an attempt that goes on with this one."""
        if self._journal is None:
            files, path_of = self.warehouse._files()
            files.delete(path_of(f"{self._scratch}/{name}"), True)

    def counted(self, name: str, what: str = ROWS) -> int:
        """What was counted when a table or an intermediate result was written."""
        if name in self.row_counts and self.warehouse.ranged(name):
            return 1  # unknown, as not all of the table was written
        return self._counted[name, what]

    def _note(self, name: str, seen: Observation) -> None:
        self._counted.update({(name, what): n for what, n in seen.get.items()})

    def target(self, name: str) -> DataFrame | None:
        """The table before this load (a history: its open rows), or None."""
        paths = self.base.tables.get(name)
        if not paths:
            return None
        if _is_history(name):
            return self.warehouse.open_rows(name, paths, self.key)
        return self.warehouse.read(name, paths, self.key)

    def in_buckets(self, name: str) -> bool:
        """Whether rows of the table are to be written in buckets, and lie in them if there are any."""
        paths = self.base.tables.get(name)
        return self.warehouse.bucketed(name) and (not paths or self.warehouse._in_buckets(name, paths[-1]))

    def merge_changes(self, name: str, source: DataFrame) -> None:
        """Merge the source into a table of key ranges, and rewrite only those in which a
        row is new or has another digest. The source is made and moved once, the old rows' keys
        and digests come to it; the rows that differ are written, and old rows are only moved
        where these are many."""
        wh, key, paths = self.warehouse, TABLES[name].key, self.base.tables.get(name, [])
        if self.finished(name):
            return
        if not paths:
            self.replace(name, source)
            return
        same = F.expr(" AND ".join(f"old.{k} <=> new.{k}" for k in key))
        old = merged(wh.range_rows(name, paths, self.key).select(*key, DIGEST))
        met = wh.marked(name, source).alias("new").join(old.alias("old"), same, "left")
        differ = f"{name}.differ"
        rows = self.keep(met.filter(f"NOT (new.{DIGEST} <=> old.{DIGEST})").select("new.*"), differ)
        changed = wh.written_ranges(f"{self._scratch}/{differ}") if self.counted(differ) else []
        kept = [_with_ranges(p, sorted(_ranges(p) - set(changed))) for p in paths]
        touched = [_with_ranges(p, sorted(_ranges(p) & set(changed))) for p in paths]
        kept, touched = [p for p in kept if _ranges(p)], [p for p in touched if _ranges(p)]
        self.row_counts[name] = 0
        self._new[name] = kept
        if changed:
            if touched:
                replaced = bounded(rows.select(*key), self.counted(differ))
                rows = rows.unionByName(anti_join_null_safe(wh.range_rows(name, touched, self.key), replaced, key))
            self._new[name] = [*kept, self._write(name, rows)]
        self._enter(TABLE, name, self._new[name])
        self.drop(differ)

    def whole_target(self, name: str) -> DataFrame | None:
        return self.warehouse.table(name, self.base) if self.base.tables.get(name) else None

    def current(self, name: str) -> DataFrame:
        """The table as this load has written it."""
        return self.warehouse.table(name, Snapshot(self.load_id, 0, self._new, self.key))

    def replace(
        self, name: str, df: DataFrame, placed: bool = False, counts: Mapping[str, str] | None = None
    ) -> None:
        """``placed``: the rows lie in partitions of the buckets already. ``counts``: see ``keep``."""
        if not self.finished(name):
            self._new[name] = [self._write(name, df, placed, counts)]
            self._enter(TABLE, name, self._new[name])

    def append(self, name: str, delta: DataFrame, placed: bool = False) -> None:
        """Add a folder; an empty delta of an insert-only table adds none. The
        last folder of a history holds its open rows, so it always counts."""
        if self.finished(name):
            return
        before, path = self.base.tables.get(name, []), self._write(name, delta, placed)
        if before and not self.row_counts[name] and not _is_history(name):
            self._new[name] = before
        else:
            self._new[name] = [*before, path]
        self._enter(TABLE, name, self._new[name])

    def carry(self, name: str) -> None:
        """Leave a table as it is."""
        self._new[name] = self.base.tables.get(name, [])

    def folders(self, name: str) -> int:
        """How many folders the table had before this load."""
        return len(self.base.tables.get(name, []))

    def _write(
        self, name: str, df: DataFrame, placed: bool = False, counts: Mapping[str, str] | None = None
    ) -> str:
        folder = f"{self.load_id}_{self._attempt}"
        if self.warehouse.bucketed(name):
            folder += f"_{self.warehouse.buckets}b"
        path = f"{self.warehouse._folder(name)}/{folder}"
        rows, ranged = df, self.warehouse.ranged(name)
        if not ranged:
            rows = df.select(*_schema(name, self.key).names)
        elif DIGEST not in df.columns:
            rows = self.warehouse.marked(name, df)
        if ranged:
            rows = rows.sortWithinPartitions(RANGE)
        if self.warehouse.bucketed(name) and not placed:
            rows = self.warehouse.placed(name, rows)
        seen, rows = _observed(rows, name, counts)  # in the tasks that write, so that each counts once
        if _is_history(name):
            path = f"{self.warehouse._folder(name)}/{SEGMENT}={folder}"
            rows = rows.selectExpr("*", f"valid_to IS NULL AS {IS_OPEN}")
        out = rows.write.format("parquet").option("compression", CODEC)
        if _is_history(name):
            out = out.partitionBy(IS_OPEN)
        if self.warehouse.bucketed(name):
            key = _bucket_key(name)
            out.bucketBy(self.warehouse.buckets, *key).sortBy(*key).option("path", path).saveAsTable(f"{name}_{folder}")
        else:
            out.save(path)
        self._note(name, seen)
        self.row_counts[name] = self._counted[name, ROWS]
        return _with_ranges(path, self.warehouse.written_ranges(path)) if ranged else path

    def commit(self) -> Snapshot:
        """Publish the load, unless another one was published since it began."""
        if self.warehouse.snapshot() != self._newest:
            raise RuntimeError(f"load {self.load_id}: another load was committed meanwhile")
        tables, now = {**self.base.tables, **self._new}, time.time_ns()
        record = [(self.load_id, now, tables, self.key)]
        spark = self.warehouse.spark
        spark.createDataFrame(record, _COMMIT).coalesce(1).write.mode("append").json(
            f"{self.warehouse.root}/commits")
        files, path_of = self.warehouse._files()
        for path in filter(None, (self._journal, self._scratch)):  # nothing reads them any more
            files.delete(path_of(path), True)
        return Snapshot(self.load_id, now, tables, self.key)


def _observed(df: DataFrame, name: str, counts: Mapping[str, str] | None) -> tuple[Observation, DataFrame]:
    seen = Observation(name)
    asked = [F.count_if(F.expr(condition)).alias(what) for what, condition in (counts or {}).items()]
    return seen, df.observe(seen, F.count(F.lit(1)).alias(ROWS), *asked)


INSERT_ONLY = ("hub_categories", "hub_geolocations", "hub_cities")


def _is_history(name: str) -> bool:
    return name in TABLES and "valid_to" in TABLES[name].columns


def _named(commits: Sequence) -> set[tuple[str, str]]:
    """(table, folder) of all that the commits name."""
    return {tuple(_folder_of(p).split("/")[-2:]) for r in commits for paths in r.tables.values() for p in paths}


def _folder_of(path: str) -> str:
    """The folder of a path that may name ranges in it."""
    return path.split(f"/{RANGE}=")[0]


def _ranges(path: str) -> set[int]:
    named = path.partition(f"/{RANGE}=")[2].strip("{}")
    return {int(n) for n in named.split(",") if n}


def _with_ranges(path: str, ranges: Sequence[int]) -> str:
    """The path of these ranges of a folder, as the file system's pattern."""
    return f"{_folder_of(path)}/{RANGE}={{{','.join(map(str, ranges))}}}"


def _bucket_key(name: str) -> tuple[str, ...]:
    """What rows are bucketed by: the key; of a history, what tells its objects apart."""
    t = TABLES[name]
    return tuple(c for c in t.key if c in t.parents) if _is_history(name) else t.key


def _schema(name: str, key: str) -> StructType:
    if name == REJECTS:
        return StructType.fromDDL(REJECTS_SCHEMA)
    if name.startswith(LEDGER):
        return StructType([StructField("id", KEY_TYPES[key]), StructField("digest", StringType())])
    if name.startswith(PROVED):
        return StructType([StructField("id", KEY_TYPES[key])])
    return TABLES[name].schema_with(KEY_TYPES[key])


def create_tables(spark: SparkSession, database: str, names: Sequence[str] | None = None) -> None:
    """Drop and create empty catalog tables with the declared types, lengths and
    NOT NULL marks."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names or TABLES:
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in TABLES[name].schema)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet")
