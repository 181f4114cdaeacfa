"""What loads leave on disk and move: intermediate tables, repeated loads, wide rows."""

from pathlib import Path

from tests.test_load import all_rows, load, write_drop
from tests.test_plans import no_broadcast, plan  # noqa: F401
from vaultloom.operators import merge
from vaultloom.sources.sample_feeds import raw_order_items
from vaultloom.sources.scratch import written
from vaultloom.sources.warehouse import RANGE, Warehouse


def test_a_published_load_leaves_no_intermediate_tables(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load(spark, wh, write_drop(tmp_path / "drop"), 1)
    assert not list((tmp_path / "wh" / "scratch").glob("*"))
    assert {f.name.split(".")[-2] for f in (tmp_path / "wh" / "data").rglob("*.parquet")} == {"zstd"}


def test_what_a_repeated_load_replaced_can_go(spark, tmp_path):
    drop = write_drop(tmp_path / "drop")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for n in (1, 2, 2):
        load(spark, wh, drop, n)
    before = all_rows(wh)
    assert len(list((tmp_path / "wh" / "data" / "orders").iterdir())) == 3
    assert wh.remove_superseded() == []
    wh.remove_superseded(attempts=True)
    assert len(list((tmp_path / "wh" / "data" / "orders").iterdir())) == 2  # load 1, to repeat load 2
    assert all_rows(wh) == before
    load(spark, wh, drop, 2)
    assert all_rows(wh) == before


def test_ranges_are_no_folders(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), ranges=50)
    load(spark, wh, write_drop(tmp_path / "drop"), 1)
    [path] = wh.snapshot().tables["orders"]
    folder = Path(path.split(f"/{RANGE}=")[0])
    assert not [f for f in folder.iterdir() if f.is_dir()]
    held = {r[0] for r in spark.read.parquet(str(folder)).select(RANGE).collect()}
    assert path == f"{folder}/{RANGE}={{{','.join(map(str, sorted(held)))}}}"


def test_few_kept_keys_are_broadcast_and_rows_not_shuffled(spark, tmp_path):
    target = written(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string"),
                     str(tmp_path), "target")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    for null_safe in (False, True):
        kept = written(merge.kept_keys(target, source, ["k"], null_safe), str(tmp_path), f"kept{null_safe}")
        got = merge.merge_upsert(target, source, ["k"], null_safe, kept)
        assert "Exchange hashpartitioning" not in plan(got)
        want = merge.merge_upsert(target, source, ["k"], null_safe)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_line_items_are_not_shuffled(spark, tmp_path, no_broadcast):  # noqa: F811
    from datetime import datetime

    row = (1, 2, 3, 4, -0.0, 9.5, datetime(1999, 1, 1))
    rows = [row, (1, 2, 3, 5, *row[4:]), (None, None, None, None, None, float("nan"), None)]
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
              "l_extendedprice double, l_shipdate timestamp_ntz")

    def items(lines, name):
        spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        return raw_order_items(spark, f"{tmp_path}/{name}", 2)

    once = items(rows, "once")
    assert "HashAggregate" not in plan(once)
    assert len({r.order_item_id for r in once.collect()}) == 3
    zeros = items([row, (*row[:4], 0.0, *row[5:]), rows[2], rows[2], rows[1]], "twice").collect()
    assert len(zeros) == 5 and len({r.order_item_id for r in zeros}) == 5  # copies are numbered
    assert {str(r.freight_value) for r in once.collect()} == {"0.0", "None"}  # both zeros are one
