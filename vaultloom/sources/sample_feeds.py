"""The nine raw feeds, derived from the driver's test tables.

``load`` is the number of the daily drop, from 1. Later drops differ: customers
move, orders progress, rows arrive and rows leave. Rows with a high balance or
price are sent two or three times, as in feeds that repeat a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.functions.keys import float_input, hash_key
from vaultloom.operators.dedup import bounded
from vaultloom.sources.scratch import scratch_folder, written
from vaultloom.sources.tables import RAW_FEEDS


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _as_feed(df: DataFrame, feed: str, **values: str) -> DataFrame:
    """The feed's columns in its types, from the SQL text given for each."""
    return df.selectExpr(*[
        f"cast({values.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in RAW_FEEDS[feed]
    ])


def _sent(df: DataFrame, copies: str) -> DataFrame:
    """Repeat each row ``copies`` times."""
    return df.selectExpr("*", f"explode(sequence(1, {copies})) AS sent")


def _balance_copies(c: str) -> str:
    return f"CASE WHEN {c} > 9500 THEN 3 WHEN {c} > 9000 THEN 2 ELSE 1 END"


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _read(spark, folder, "nation"), _read(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def _customer_places(spark: SparkSession, folder: str, load: int) -> DataFrame:
    c, places = _read(spark, folder, "customer"), _places(spark, folder)
    here = "NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 5000)"
    if load > 1:
        here = "NOT (c_mktsegment = 'BUILDING' AND c_acctbal > 8000)"
    return c.filter(here).join(places, c.c_nationkey == places.n_nationkey).selectExpr(
        "*",
        "1000 + c_nationkey * 40 + c_custkey % 40"
        f" + CASE WHEN c_acctbal < 0 THEN {load - 1} ELSE 0 END AS zip",
        "concat(lower(c_mktsegment), '-do d\\'', lower(n_name)) AS city",
    )


def _supplier_places(spark: SparkSession, folder: str, load: int) -> DataFrame:
    s, places = _read(spark, folder, "supplier"), _places(spark, folder)
    return s.join(places, s.s_nationkey == places.n_nationkey).selectExpr(
        "*",
        "1000 + s_nationkey * 40 + s_suppkey % 40"
        f" + CASE WHEN s_acctbal < 0 THEN {load - 1} ELSE 0 END AS zip",
        "concat('são ', lower(n_name), '-mirim') AS city",
    )


def raw_customers(spark: SparkSession, folder: str, load: int) -> DataFrame:
    return _as_feed(
        _sent(_customer_places(spark, folder, load), _balance_copies("c_acctbal")), "customers",
        customer_id="concat('C', c_custkey)",
        customer_unique_id="c_name",
        customer_zip_code_prefix="zip",
        customer_city="city",
        customer_state="r_name",
    )


def raw_sellers(spark: SparkSession, folder: str, load: int) -> DataFrame:
    return _as_feed(
        _sent(_supplier_places(spark, folder, load), _balance_copies("s_acctbal")), "sellers",
        seller_id="concat('S', s_suppkey)",
        seller_zip_code_prefix="zip",
        seller_city="city",
        seller_state="r_name",
    )


def raw_geolocation(spark: SparkSession, folder: str, load: int) -> DataFrame:
    """One point per customer and supplier, on a grid of exact 64ths of a degree."""
    def points(df: DataFrame, number: str, balance: str) -> DataFrame:
        return _as_feed(
            _sent(df, _balance_copies(balance)), "geolocation",
            geolocation_zip_code_prefix="zip",
            geolocation_lat=f"({number} % 11520) / 64.0D - 90.0D",
            geolocation_lng=f"floor({balance}) / 64.0D",
            geolocation_city="city",
            geolocation_state="r_name",
        )

    customers = points(_customer_places(spark, folder, load), "c_custkey", "c_acctbal")
    sellers = points(_supplier_places(spark, folder, load), "s_suppkey", "s_acctbal")
    return customers.unionByName(sellers)


def _orders_of_load(spark: SparkSession, folder: str, load: int) -> DataFrame:
    here = "o_orderdate < TIMESTAMP_NTZ'2001-01-01 00:00:00'"
    if load > 1:
        here = "o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP_NTZ'1996-01-01 00:00:00'"
    return _read(spark, folder, "orders").filter(here)


def raw_orders(spark: SparkSession, folder: str, load: int) -> DataFrame:
    orders = _orders_of_load(spark, folder, load)
    shipped = _read(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    joined = orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left")
    start = "CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
    progress = f"CASE WHEN o_totalprice > 250000 THEN {load - 1} ELSE 0 END"
    return _as_feed(
        _sent(joined, "CASE WHEN o_totalprice > 490000 THEN 2 ELSE 1 END"), "orders",
        order_id="concat('O', o_orderkey)",
        customer_id="concat('C', o_custkey)",
        order_status=f"element_at(array('processing', 'shipped', 'DELIVERED'), ({start} + {progress}) % 3 + 1)",
        order_purchase_timestamp="o_orderdate",
        order_approved_at="o_orderdate + INTERVAL 1 DAY",
        order_delivered_carrier_date="first_ship",
        order_delivered_customer_date="last_ship",
        order_estimated_delivery_date="o_orderdate + INTERVAL 30 DAYS",
    )


def _noun() -> str:
    return "split_part(p_name, ' ', 2)"


def _category() -> str:
    return f"concat(lower(p_type), '_', {_noun()})"


def raw_products(spark: SparkSession, folder: str, load: int) -> DataFrame:
    parts = _read(spark, folder, "part")
    if load == 1:
        parts = parts.filter("NOT (p_type = 'LARGE' AND p_size >= 40)")
    return _as_feed(
        _sent(parts, "CASE p_size WHEN 49 THEN 3 WHEN 50 THEN 2 ELSE 1 END"), "products",
        product_id="concat('P', p_partkey)",
        product_category_name=f"CASE WHEN p_size <> 13 THEN {_category()} END",
        product_name_lenght="length(p_name)",
        product_description_lenght="p_size * 10",
        product_photos_qty="p_size % 5",
        product_weight_g=f"p_size * 100 + CASE WHEN p_retailprice > 990 THEN {load - 1} ELSE 0 END",
        product_length_cm="p_size + 0.5D",
        product_height_cm="p_size / 2.0D",
        product_width_cm="p_retailprice",
    )


def raw_translation(spark: SparkSession, folder: str, load: int) -> DataFrame:
    """Two types share one English name; one category has no translation."""
    known = _read(spark, folder, "part").filter(f"NOT (p_type = 'MEDIUM' AND {_noun()} = 'rod')")
    kind = "CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'budget' ELSE lower(p_type) END"
    return _as_feed(
        known, "translation",
        product_category_name=_category(),
        product_category_name_english=f"concat({_noun()}, '_', {kind})",
    ).distinct()


def raw_order_items(spark: SparkSession, folder: str, load: int) -> DataFrame:
    """All line items. The item number is derived from what tells an order's lines apart;
    lines alike in all of it are counted, which folds them in the tasks, and numbered. Only
    hashes of 8 bytes are moved to find these; other lines stay where they are."""
    lines = _read(spark, folder, "lineitem")
    if load == 1:
        lines = lines.filter("l_shipdate < TIMESTAMP_NTZ'2001-01-01 00:00:00'")
    told = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity"]
    # As in a grouping, both zeros are one.
    floats = {c: f"{c} + 0D AS {c}" for c in ("l_extendedprice", "l_quantity")}
    lines = lines.selectExpr(*[floats.get(c, c) for c in told], f"xxhash64({', '.join(told)}) AS line_hash")
    alike = bounded(written(
        lines.groupBy("line_hash").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("line_hash"),
        scratch_folder(spark), "alike"))
    several = lines.join(alike, "line_hash", "left_semi").groupBy(*told).agg(F.count(F.lit(1)).alias("copies"))
    single = lines.join(alike, "line_hash", "left_anti").selectExpr(*told, "1L AS copies")
    items = single if alike.isEmpty() else single.unionByName(several)
    items = _sent(items, "cast(copies AS int)")
    return _as_feed(
        items, "order_items",
        order_id="concat('O', l_orderkey)",
        order_item_id=hash_key(
            "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", float_input("l_extendedprice"),
            float_input("l_quantity"), "sent"),
        product_id="concat('P', l_partkey)",
        seller_id="concat('S', l_suppkey)",
        shipping_limit_date="l_shipdate",
        price="l_extendedprice",
        freight_value=f"l_quantity + CASE WHEN l_linenumber = 7 THEN {load - 1} ELSE 0 END",
    )


def raw_payments(spark: SparkSession, folder: str, load: int) -> DataFrame:
    orders = _orders_of_load(spark, folder, load)
    parts = "CASE WHEN o_totalprice > 250000 THEN 2 ELSE 1 END"
    return _as_feed(
        _sent(orders, parts), "payments",
        order_id="concat('O', o_orderkey)",
        payment_sequential="sent",
        payment_type="translate(lower(substr(o_orderpriority, 3)), ' ', '_')",
        payment_installments="o_custkey % 12 + 1",
        payment_value=f"o_totalprice / {parts}",
    )


def raw_reviews(spark: SparkSession, folder: str, load: int) -> DataFrame:
    """Documents as reviews; equal texts get the same id, so copies are duplicates. The id
    is made before the join, so that who needs no text moves none."""
    docs = _read(spark, folder, "documents").selectExpr("*", "md5(text) AS text_key")
    if load == 1:
        docs = docs.filter("lang <> 'fr'")
    written = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(doc_id AS decimal(18, 6)))"
    return _as_feed(
        docs.join(_read(spark, folder, "labels"), "doc_id", "left"), "reviews",
        review_id="text_key",
        order_id="concat('O', doc_id)",
        review_score="coalesce(1 + 4 * quality, 3)"
        f" + CASE WHEN lang = 'de' AND quality = 0 THEN {load - 1} ELSE 0 END",
        review_comment_title="CASE WHEN source <> 'src7' THEN concat(lang, ' ', source) END",
        review_comment_message="CASE WHEN coalesce(toxic, 0) <> 1 THEN text END",
        review_creation_date=written,
        review_answer_timestamp=f"{written} + INTERVAL 36 HOURS",
    )


FEEDS = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "orders": raw_orders,
    "products": raw_products,
    "translation": raw_translation,
    "sellers": raw_sellers,
    "order_items": raw_order_items,
    "payments": raw_payments,
    "reviews": raw_reviews,
}


def raw_feed(spark: SparkSession, folder: str, feed: str, load: int = 1) -> DataFrame:
    return FEEDS[feed](spark, folder, load)
