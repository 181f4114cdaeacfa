"""One key holds a third of the rows."""

from collections import Counter

import pytest

from vaultloom.operators import dedup, quality
from vaultloom.plans import vault
from vaultloom.sources.scratch import written

ROWS = 300_000


@pytest.fixture(scope="module")
def items(spark, tmp_path_factory):
    hot = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 100000) END"
    df = spark.range(ROWS).selectExpr(
        "concat('o', id) AS order_id", "id AS order_item_id", f"{hot} AS product_id",
        "concat('s', id % 10) AS seller_id", "cast(NULL AS timestamp_ntz) AS shipping_limit_date",
        "1.5D AS price", "id / 2.0D AS freight_value")
    return written(df, str(tmp_path_factory.mktemp("skew")), "items")


def shuffled_rows(df):
    """The rows that each exchange of the executed plan wrote."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            written_rows = node.metrics().get("shuffleRecordsWritten")
            found.append(written_rows.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_drop_all_duplicates(items, spark, tmp_path):
    few = written(dedup.duplicate_keys(items, ["product_id"]), str(tmp_path), "dup")
    got = dedup.drop_all_duplicates(items, ["product_id"], few)
    copies = Counter("hot" if i % 3 == 0 else f"k{i % 100000}" for i in range(ROWS))
    assert got.count() == sum(1 for n in copies.values() if n == 1)


def test_hot_values_are_folded_before_the_exchange(items):
    tasks = items.rdd.getNumPartitions()
    seen = shuffled_rows(items.groupBy("seller_id").count())
    assert max(seen) <= 10 * tasks
    orphans = quality.orphan_keys(items.filter("product_id = 'hot'"), "product_id",
                                  items.selectExpr("seller_id AS id").distinct(), "id")
    assert max(shuffled_rows(orphans)) <= 10 * tasks


def test_rows_with_a_hot_reference_are_not_shuffled(items, spark, tmp_path):
    job = vault.JOBS["l_order_items"]
    known = items.select("product_id").distinct().filter("product_id <> 'k7'")
    hubs = {
        "hub_products": known.selectExpr(f"{vault.PRODUCT.expression()} AS id"),
        "hub_orders": items.selectExpr(f"{vault.ORDER.expression()} AS id"),
    }
    rows = vault.business_rows(job, items)
    missing = vault.missing_references(
        job, rows, hubs, keep=lambda df, name: written(df, str(tmp_path), name))
    source = vault.source_rows(job, rows, missing, "2024-01-01 01:00:00", "x")
    expected = sum(1 for i in range(ROWS) if i % 3 == 0 or i % 100000 != 7)
    assert source.count() == expected
    assert shuffled_rows(source.select("order_item_id")) == []
