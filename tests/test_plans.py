"""What the planner makes of the operators."""

import pytest

from vaultloom.operators import dedup, history, merge
from vaultloom.plans import vault
from vaultloom.sources.scratch import written
from vaultloom.sources.warehouse import Warehouse

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_upsert_is_one_anti_join_on_keys(spark, no_broadcast):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    text = plan(merge.merge_upsert(orders, orders, ["o_orderkey"]))
    assert text.count("LeftAnti") == 1 and "Cartesian" not in text and "NestedLoop" not in text


def test_known_duplicates_are_broadcast_and_rows_not_shuffled(spark, tmp_path):
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    few = written(dedup.duplicate_keys(lines, keys), str(tmp_path), "dup")
    text = plan(dedup.drop_all_duplicates(lines, keys, few))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_duplicate_keys_read_only_the_keys(spark):
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet")
    text = plan(dedup.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert text.count("HashAggregate") == 2


def test_history_reads_each_side_once(spark, no_broadcast):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").selectExpr("o_orderkey AS k", "o_orderstatus AS v")
    state = history.first_load(orders, "2024-01-01 00:00:00")
    text = plan(history.advance(state, orders, ["k"], ["v"], "2024-01-02 00:00:00"))
    assert text.count("FileScan") == 2 and text.count("FullOuter") == 1


def test_business_rows_filter_and_prune_at_the_scan(spark, tmp_path):
    items = spark.createDataFrame(
        [("o", 1, "p", "s", None, 1.0, 2.0)],
        "order_id string, order_item_id bigint, product_id string, seller_id string,"
        " shipping_limit_date timestamp_ntz, price double, freight_value double")
    staged = written(items, str(tmp_path), "items")
    text = plan(vault.business_rows(vault.JOBS["l_product_seller"], staged))
    assert "ReadSchema: struct<product_id:string,seller_id:string>" in text
    assert "PushedFilters: [IsNotNull(product_id), IsNotNull(seller_id)]" in text
    assert "md5" not in text


def test_bucketed_target_is_not_shuffled(spark, tmp_path, no_broadcast):
    wh = Warehouse(spark, str(tmp_path), buckets=4)
    rows = spark.range(100).selectExpr(
        "id", "concat('o', id) AS order_id", *merge.audit_columns("2024-01-01 00:00:00", "x"))
    load = wh.begin("2024-01-01 00:00:00")
    load.replace("hub_orders", rows)
    load.commit()
    text = plan(merge.merge_upsert(wh.table("hub_orders"), rows, ["id"]))
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
