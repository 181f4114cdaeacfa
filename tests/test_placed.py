"""Bucketed merges: plans of the writes, files, and a warehouse whose buckets change."""

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from tests.test_load import all_rows, load, write_drop
from vaultloom.sources.warehouse import Warehouse


def write_plans(spark, folder):
    """The final plans of the writes to a folder."""
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = []
    for i in range(executions.size()):
        plan = executions.apply(i).physicalPlanDescription()
        if f"/{folder}," in plan and "Execute InsertIntoHadoopFsRelationCommand" in plan:
            found.append(plan.split("+- == Initial Plan ==")[0])
    return found


def test_a_bucketed_load_moves_sources_only(spark, tmp_path):
    drop = write_drop(tmp_path / "drop")
    wh, plain = Warehouse(spark, str(tmp_path / "wh"), buckets=3), Warehouse(spark, str(tmp_path / "plain"))
    for n in (1, 2):
        load(spark, wh, drop, n)
        load(spark, plain, drop, n)
    assert all_rows(wh) == all_rows(plain)
    for table in ("orders", "sat_order_details", "sat_order_statuses", "l_order_items"):
        path = Path(wh.snapshot().tables[table][-1])
        [plan] = write_plans(spark, f"{table}/{path.name}")
        above, below = plan.split("SortMergeJoin FullOuter")
        target, source = below.split("* Sort")[1:3]
        assert "Exchange" not in above and "Exchange" not in target, plan
        assert f"Scan parquet spark_catalog.default.{table}" in target and source.count("Exchange (") >= 1, plan
        files = list(path.glob("is_open=true/*.parquet")) or list(path.glob("*.parquet"))
        buckets = Counter(re.search(r"_(\d{5})\.", f.name)[1] for f in files)
        assert max(buckets.values()) == 1, files  # each bucket written by one task


def test_buckets_may_change_between_loads(spark, tmp_path):
    drop = write_drop(tmp_path / "drop")
    root = str(tmp_path / "wh")
    for n, buckets in ((1, None), (2, 2), (3, 3), (4, None)):
        wh = Warehouse(spark, root, buckets)
        load(spark, wh, drop, n)
        statuses = wh.table("sat_order_statuses")
        assert statuses.count() == 3 and statuses.filter("valid_to IS NULL").count() == 3
        assert wh.table("orders").agg(F.count("*")).first()[0] == 3
