"""Which join sides may be broadcast: written keys that are known to be few, whatever their files' size."""

from pyspark.sql import functions as F

from tests.test_plans import plan
from vaultloom.operators import dedup, merge, quality
from vaultloom.plans import vault
from vaultloom.sources.scratch import CODEC, written


def orders(spark, n):
    return spark.range(n).selectExpr("concat('O', id) AS order_id", "id % 7 AS x")


def test_many_keys_are_merged_though_their_files_are_small(spark, tmp_path):
    rows = written(orders(spark, 1000), str(tmp_path), "rows")
    few, many = written(orders(spark, 10), str(tmp_path), "few"), written(
        orders(spark, dedup.MOST_BROADCAST + 1), str(tmp_path), "many", CODEC)
    limit = int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b"))
    assert many._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < limit
    for keys, kind in ((few, "BroadcastHashJoin"), (many, "SortMergeJoin")):
        got = dedup.drop_all_duplicates(rows, ["order_id"], dedup.bounded(keys))
        assert plan(got).count("Join") == 1 and kind in plan(got)
        assert got.count() == (990 if keys is few else 0)
        assert kind in plan(merge.merge_upsert(rows, rows.limit(0), ["order_id"], kept=dedup.bounded(keys)))
    assert "SortMergeJoin" in plan(dedup.drop_all_duplicates(rows, ["order_id"], dedup.bounded(few, 10**9)))


def test_hubs_and_targets_are_not_broadcast_and_rows_fold_first(spark, tmp_path):
    rows = written(orders(spark, 1000), str(tmp_path), "rows")
    job = vault.JOBS["sat_order_details"]
    hub = written(orders(spark, 900).selectExpr(f"{job.refs['order_id'].expression()} AS id"), str(tmp_path), "hub")
    found = vault.orphans(job, rows, "order_id", {"hub_orders": hub})
    assert found.count() == 100
    for df in (
            found, quality.orphan_keys(rows, "order_id", rows.limit(9), "order_id"),
            merge.new_rows(rows.limit(9), rows.select("order_id").distinct(), ["order_id"])):
        above, below = plan(df).split("SortMergeJoin", 1)
        assert "Broadcast" not in below and "HashAggregate" not in above and "HashAggregate" in below
    assert "Broadcast" not in plan(merge.kept_keys(rows, rows, ["order_id"]))
    assert "Broadcast" not in plan(merge.kept_keys(rows, rows, ["order_id"], null_safe=True))


def test_not_among_keeps_nulls_and_copies(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    others = spark.createDataFrame([(2, 0), (2, 1), (None, 2)], "k int, w int")
    want = df.join(others, "k", "left_anti")
    assert sorted(dedup.not_among(df, others, ["k"]).collect(), key=str) == sorted(want.collect(), key=str)
    assert dedup.not_among(df, others.filter(F.lit(False)), ["k"]).count() == 4
