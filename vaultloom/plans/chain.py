"""The state of a table after several loads, as a DataFrame over the raw feeds.

Without ``keep`` this is one lazy plan. With it, states that are read more than
once (staging tables, hubs, orphan keys) go through written tables, as they do
in a real load: that cuts the lineage and tells the planner their sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from vaultloom.operators.dedup import bounded, duplicate_keys
from vaultloom.operators.history import CLOSE_OPEN_ONLY
from vaultloom.operators.quality import expect_none, merge_ambiguity
from vaultloom.plans import prep, staging, vault


class Chain:
    """``feed(name, n)`` gives raw drop ``n``; ``load_ts(n)`` its load time."""

    def __init__(
        self,
        feed: Callable[[str, int], DataFrame],
        load_ts: Callable[[int], str],
        load_src: str,
        strict: bool = False,
        keep: Callable[[DataFrame, str], DataFrame] | None = None,
    ) -> None:
        self._feed, self.load_ts, self.load_src, self._strict = feed, load_ts, load_src, strict
        self._keep = keep
        self._states: dict[tuple, DataFrame] = {}

    def _once(self, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._states:
            self._states[key] = make()
        return self._states[key]

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return self._keep(df, name) if self._keep else df

    def _keeper(self, n: int):
        return (lambda df, name: self._keep(df, f"{name}-{n}")) if self._keep else None

    def prepared(self, feed: str, n: int) -> DataFrame:
        """Cleaned drop ``n`` of a feed. Duplicated keys and the translation are
        kept: both are small beside the rows they meet."""
        def make():
            raw, keys, translation, duplicates = self._feed(feed, n), prep.DEDUP_KEYS.get(feed), None, None
            if feed == "products":
                translation = self._kept(self._feed("translation", n), f"translation-{n}")
                if self._keep:
                    expect_none(merge_ambiguity(translation, prep.TRANSLATION_KEY),
                                "translation: several rows share a category name")
            if keys and self._keep:
                duplicates = bounded(self._keep(duplicate_keys(raw, keys), f"duplicates.{feed}-{n}"))
            return prep.prepare(feed, raw, translation, duplicates)
        return self._once(("prepared", feed, n), make)

    def prepared_kept(self, feed: str, n: int) -> DataFrame:
        """The same, written, for those who read it several times."""
        return self._once(("prepared kept", feed, n), lambda: self._kept(self.prepared(feed, n), f"prepared.{feed}-{n}"))

    def staged(self, table: str, n: int) -> DataFrame:
        """The staging table after drop ``n``."""
        def make():
            before = self.staged(table, n - 1) if n > 1 else None
            return staging.load_staging(table, before, self.prepared(table, n))
        return self._once(("staged", table, n), make)

    def staged_kept(self, table: str, n: int) -> DataFrame:
        def make():
            before = self.staged_kept(table, n - 1) if n > 1 else None
            # a merge reads its source twice, keys and rows
            again = before is not None or ("prepared kept", table, n) in self._states
            rows = self.prepared_kept(table, n) if again else self.prepared(table, n)
            return self._kept(staging.load_staging(table, before, rows, self._keeper(n)), f"{table}-{n}")
        return self._once(("staged kept", table, n), make)

    def business(self, table: str, n: int) -> DataFrame:
        """The staging rows that load ``n`` brings to a vault table."""
        job = vault.JOBS[table]
        return self._once(("business", table, n), lambda: vault.business_rows(
            job, self.staged_kept(job.source, n), self._keeper(n)))

    def missing(self, table: str, n: int) -> dict[str, DataFrame]:
        job, parents = vault.JOBS[table], vault.TABLES[table].parents

        def make():
            checked = vault.checked_references(job, self._strict)
            self.stage_together({job.source, *(vault.JOBS[parents[c]].source for c in checked)}, n)
            hubs = {parents[c]: self.vault(parents[c], n) for c in checked}
            found = vault.missing_references(job, self.business(table, n), hubs, self._strict)
            keep = self._keeper(n)
            if not (keep and found):
                return found
            with ThreadPoolExecutor(len(found)) as pool:
                return dict(zip(found, pool.map(
                    lambda c: bounded(keep(found[c], f"{table}.{c}")), found), strict=True))
        return self._once(("missing", table, n), make)

    def prepare_together(self, feeds: Collection[str], loads: int) -> None:
        """Write independent drops of the feeds at the same time."""
        drops = [(feed, n) for feed in feeds for n in range(1, loads + 1)]
        with ThreadPoolExecutor(len(drops)) as pool:
            list(pool.map(lambda drop: self.prepared_kept(*drop), drops))

    def stage_together(self, tables: Collection[str], n: int) -> None:
        """Write independent staging tables at the same time, as a load does."""
        if self._keep and len(tables) > 1:
            with ThreadPoolExecutor(len(tables)) as pool:
                list(pool.map(lambda t: self.staged_kept(t, n), sorted(tables)))

    def source(self, table: str, n: int) -> DataFrame:
        """The rows that load ``n`` merges into a vault table."""
        return self._once(("source", table, n), lambda: vault.source_rows(
            vault.JOBS[table], self.business(table, n), self.missing(table, n),
            self.load_ts(n), self.load_src))

    def vault(self, table: str, n: int, close: str = CLOSE_OPEN_ONLY) -> DataFrame:
        """A vault table after load ``n``."""
        job = vault.JOBS[table]

        def make():
            source = self.source(table, n)  # first: it stages all drops side by side
            before = self._before(job, n, close) if n > 1 else None
            return vault.load_table(job, before, source, self.load_ts(n), close, keep=self._keeper(n))
        return self._once(("vault", table, n, close), make)

    def _before(self, job: vault.Job, n: int, close: str) -> DataFrame:
        """The state before load ``n``. A history reads it twice (open and closed
        rows), so it is kept; an upsert reads its target once."""
        state = self.vault(job.table, n - 1, close)
        if job.mode != vault.HISTORY:
            return state
        return self._once(
            ("before", job.table, n, close),
            lambda: self._kept(state, f"{job.table}-{n - 1}-{close}"))
