"""Key ranges: what a load rewrites, and what the table then holds."""

import re
from pathlib import Path

import pytest

from tests.test_load import AT, DROP, load, rows, write_drop
from tests.test_placed import write_plans
from vaultloom.sources.tables import TABLES
from vaultloom.sources.warehouse import RANGE, Warehouse


def test_only_changed_ranges_are_rewritten(spark, tmp_path):
    first = write_drop(tmp_path / "1")
    second = write_drop(tmp_path / "2", {
        "orders": [DROP["orders"][0].replace(AT, "2024-01-05 10:00:00", 1), *DROP["orders"][1:]]})
    wh, plain = Warehouse(spark, str(tmp_path / "wh"), ranges=50), Warehouse(spark, str(tmp_path / "plain"))
    load(spark, wh, first, 1)
    after_first = wh.snapshot()
    load(spark, wh, first, 2)
    repeated = wh.snapshot()
    for t in TABLES:
        if wh.ranged(t):
            assert repeated.tables[t] == after_first.tables[t], t  # an equal load writes nothing
    load(spark, wh, second, 3)
    written = {t: wh.ranges_of(t, wh.snapshot().load_id) for t in TABLES if wh.ranged(t)}
    assert {t: n for t, n in written.items() if n} == {"orders": 1, "sat_order_details": 1}
    load(spark, plain, second, 3)
    for name, t in TABLES.items():
        columns = [c for c in t.columns if c not in ("load_dttm", "load_src", "valid_from", "valid_to")]
        assert rows(wh.table(name), *columns) == rows(plain.table(name), *columns), name
    days = {r.load_dttm.day for r in wh.table("sat_order_details").collect()}
    assert days == {1, 3}  # the load that last changed the row
    gone = [g for g in wh.remove_superseded() if "/data/" in g]
    assert all(Path(p.split(f"/{RANGE}=")[0]).exists() for paths in wh.snapshot().tables.values() for p in paths)
    assert not any("/data/orders/" in g for g in gone)  # ranges of the first load still count
    assert wh.table("orders").count() == 3


def test_buckets_and_ranges_exclude_each_other(spark, tmp_path):
    with pytest.raises(ValueError, match="not both"):
        Warehouse(spark, str(tmp_path), buckets=2, ranges=2)


def test_rows_that_differ_are_made_and_moved_once(spark, tmp_path):
    """No exchange deals whole rows by range, and few rows that differ are broadcast to the old ones."""
    drop = write_drop(tmp_path / "1")
    later = write_drop(tmp_path / "2", {
        "orders": [DROP["orders"][0].replace(AT, "2024-01-05 10:00:00", 1), *DROP["orders"][1:]]})
    wh = Warehouse(spark, str(tmp_path / "wh"), ranges=50)
    load(spark, wh, drop, 1)
    load(spark, wh, later, 2)
    for folder in Path(wh._folder("orders")).iterdir():
        [plan] = write_plans(spark, f"orders/{folder.name}")
        assert "SortMergeJoin" not in plan and not re.search(r"(?<!Broadcast)Exchange \(", plan), plan
    assert not list((tmp_path / "wh" / "scratch").glob("*"))
