"""A load that failed is taken up where it ended."""

import pytest

from tests.test_load import all_rows, load, rows, write_drop
from tests.test_placed import write_plans
from vaultloom.plans import pipeline
from vaultloom.sources.tables import HUB, TABLES
from vaultloom.sources.warehouse import REJECTS, Warehouse


def test_a_repeat_goes_on_at_the_failed_job(spark, tmp_path, monkeypatch):
    drop = write_drop(tmp_path / "drop")
    wh, plain = Warehouse(spark, str(tmp_path / "wh")), Warehouse(spark, str(tmp_path / "plain"))
    real = pipeline._merge

    def fails(load, job, source, settings):
        if job.table == "l_order_items":
            raise RuntimeError("lost")
        real(load, job, source, settings)

    monkeypatch.setattr(pipeline, "_merge", fails)
    with pytest.raises(RuntimeError, match="lost"):
        load(spark, wh, drop, 1, resume=True)
    assert wh.snapshot().tables == {}
    begun = []
    monkeypatch.setattr(pipeline, "_merge", lambda load, job, *rest: (begun.append(job.table), real(load, job, *rest)))
    load(spark, wh, drop, 1, resume=True)
    hubs = [t for t in TABLES if TABLES[t].layer == HUB]
    assert "l_order_items" in begun and not set(begun) & set(hubs)
    state = wh.snapshot()
    for t in [*hubs, "orders", "l_order_items"]:  # written once, in the folder of the first attempt
        assert len(write_plans(spark, f"{t}/" + state.tables[t][0].rsplit("/", 1)[1])) == 1, t
    assert len({p.rsplit("_", 1)[1] for paths in state.tables.values() for p in paths}) == 1
    load(spark, plain, drop, 1)
    assert all_rows(wh) == all_rows(plain)
    assert rows(wh.table(REJECTS), "table_name", "reason") == rows(plain.table(REJECTS), "table_name", "reason")
    assert not list((tmp_path / "wh" / "journal").glob("*"))  # a published load needs none


def test_what_is_not_taken_up(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    one = spark.createDataFrame([(1,)], "x int")

    def begin(what, n=1):
        return wh.begin(f"2024-01-0{n} 00:00:00", resume=what)

    first = begin("a")
    first.keep(one, "x")
    assert begin("a")._attempt == first._attempt  # the same load
    assert begin("b")._attempt != first._attempt  # other settings
    assert begin("a", 2)._attempt != first._attempt  # another load
    assert wh.begin("2024-01-01 00:00:00")._attempt != first._attempt  # without a journal
    again = begin("a")
    assert again.keep(one.selectExpr("x + 1 AS x"), "x").first().x == 1  # not made anew
    assert again.counted("x") == 1
    wh.begin("2024-01-01 00:00:00").commit()
    assert begin("a")._attempt != first._attempt  # from another state

