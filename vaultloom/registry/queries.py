"""One query per job and operator. Each takes (session, data folder).

Vault tables are shown after two loads (histories after three). States that
several steps read go through written tables, as in a real load.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultloom.functions import people
from vaultloom.functions.keys import HEX128, hash_key, hex_key, key_inputs
from vaultloom.operators import dedup, history, merge, quality
from vaultloom.plans import rules, staging, vault
from vaultloom.plans.chain import Chain
from vaultloom.plans.pipeline import Settings, run_load
from vaultloom.sources import csv_files
from vaultloom.sources.sample_feeds import raw_feed
from vaultloom.sources.scratch import CODEC, scratch_folder, written
from vaultloom.sources.tables import RAW_FEEDS, TABLES
from vaultloom.sources.warehouse import REJECTS, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

LOAD_SRC = "raw-feeds"


def load_ts(n: int) -> str:
    return f"2024-01-{n:02d} 01:00:00"


def chain(spark: SparkSession, folder: str) -> Chain:
    scratch = scratch_folder(spark)
    return Chain(
        lambda feed, n: raw_feed(spark, folder, feed, n), load_ts, LOAD_SRC,
        keep=lambda df, name: written(df, scratch, name, CODEC))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def loads_shown(table: str) -> int:
    return 3 if vault.JOBS[table].mode == vault.HISTORY else 2


# Sources and sinks -----------------------------------------------------------
def csv_scan(spark, folder):
    """Raw reviews written as CSV, multi-line texts included, and scanned back."""
    path = f"{scratch_folder(spark)}/reviews"
    csv_files.write_csv(raw_feed(spark, folder, "reviews", 2), path)
    return csv_files.csv_scan(spark, path, RAW_FEEDS["reviews"])[0]


def csv_roundtrip(spark, folder):
    """Prepared orders of both drops through the CSV writer and the typed loader."""
    path, c, drops = f"{scratch_folder(spark)}/orders", chain(spark, folder), []
    for n in (1, 2):
        csv_files.write_csv(c.prepared("orders", n), f"{path}/{n}")
        rows = csv_files.typed_load(spark, f"{path}/{n}", TABLES["orders"].plain_schema, multiline=False)[0]
        drops.append(rows.withColumn("load_no", F.lit(n)))
    return reduce(DataFrame.unionByName, drops)


def _untidy_items(spark, folder):
    """Line items as a CSV in which some cells do not have their column's type, and some
    records have a cell more than there are columns."""
    path, columns = f"{scratch_folder(spark)}/items", TABLES["order_items"].plain_schema
    lines = _table(spark, folder, "lineitem").selectExpr(
        "concat('O', l_orderkey) AS order_id", "l_linenumber AS order_item_id",
        "concat('P', l_partkey) AS product_id", "concat('S', l_suppkey) AS seller_id",
        "CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'not yet'"
        " ELSE cast(l_shipdate AS string) END AS shipping_limit_date",
        "CASE WHEN l_discount = 0.1D THEN 'zz' ELSE cast(l_extendedprice AS string) END AS price",
        "CASE WHEN l_tax > 0 THEN l_quantity END AS freight_value",
        "CASE WHEN l_tax = 0.08D THEN ',one more' ELSE '' END AS more",
    )
    cells = [f"coalesce(cast({c} AS string), '')" for c in columns.names]
    lines.selectExpr(f"concat(concat_ws(',', {', '.join(cells)}), more) AS value").write.text(path)
    return csv_files.typed_load(spark, path, columns, header=False, multiline=False)


def typed_load_good(spark, folder):
    return _untidy_items(spark, folder)[0]


def typed_load_rejects(spark, folder):
    return _untidy_items(spark, folder)[1]


def load_counts(spark, folder):
    """Rows of every staging table after two loads."""
    c = chain(spark, folder)
    c.stage_together(staging.STAGING_TABLES, 2)
    counts = [
        c.staged_kept(t, 2).agg(F.count(F.lit(1)).alias("row_count")).selectExpr(
            f"'{t}' AS table_name", "row_count")
        for t in staging.STAGING_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def append_batch(spark, folder):
    """Payments appended by two loads, the second one run twice."""
    c = chain(spark, folder)
    state = None
    for n in (1, 2, 2):
        state = merge.replace_batch(state, c.prepared("payments", n), "load_batch", load_ts(n))
    return state


# Operators -------------------------------------------------------------------
def dedup_drop_all(spark, folder):
    lines, keys = _table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    duplicates = written(dedup.duplicate_keys(lines, keys), scratch_folder(spark), "duplicates")
    return dedup.drop_all_duplicates(lines, keys, duplicates)


def union_all(spark, folder):
    """All orders under their key, and the changed ones once more without it."""
    c = chain(spark, folder)
    keyed = c.source("sat_order_statuses", 2)
    changed = history.changed_keys(
        c.vault("sat_order_statuses", 1), keyed, ["order_id"], ["order_status"])
    return keyed.selectExpr("order_id AS join_key", "order_id", "order_status").unionByName(
        changed.selectExpr("cast(NULL AS bigint) AS join_key", "order_id", "order_status"))


def distinct_rows(spark, folder):
    return _table(spark, folder, "events").select("user_id", "event_type").distinct()


def hash_key_1(spark, folder):
    return _table(spark, folder, "documents").selectExpr(
        "doc_id", f"{hash_key('text')} AS text_key", f"{hex_key('text')} AS text_hex")


def hash_key_n(spark, folder):
    events = _table(spark, folder, "events")
    return events.selectExpr(
        "event_id", f"{hash_key(*key_inputs(events.schema, ['user_id', 'ts', 'value']))} AS event_key",
        f"{hash_key('event_type', 'nullif(user_id, 8)')} AS type_key")


def merge_upsert(spark, folder):
    """Customers whose balance changed, and new ones, merged into those known."""
    customers = _table(spark, folder, "customer")
    target = customers.filter("c_mktsegment <> 'HOUSEHOLD'")
    source = customers.filter("c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')").selectExpr(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal + 100 AS c_acctbal", "c_mktsegment")
    return merge.merge_upsert(target, source, ["c_custkey"])


def merge_insert_only(spark, folder):
    """Users seen by clicks first, then every user; the first sight stays."""
    events = _table(spark, folder, "events")
    clicked = events.filter("event_type = 'click' AND value > 50").select("user_id").distinct()
    seen = events.select("user_id").distinct()
    return merge.merge_insert(
        clicked.selectExpr("user_id", "'click' AS first_seen"),
        seen.selectExpr("user_id", "'any' AS first_seen"), ["user_id"])


def scd2_changed_keys(spark, folder):
    c = chain(spark, folder)
    return history.changed_keys(
        c.vault("sat_customers_geolocation", 1), c.source("sat_customers_geolocation", 2),
        ["customer_id"], ["zip_code"]).select("customer_id", "zip_code")


def _history_in_both_modes(spark, folder, loads):
    c = chain(spark, folder)
    states = [
        c.vault("sat_order_statuses", loads, close).selectExpr("*", f"'{close}' AS close_mode")
        for close in (history.CLOSE_OPEN_ONLY, history.CLOSE_ALL_DIFFERING)
    ]
    return states[0].unionByName(states[1])


def scd2_two_loads(spark, folder):
    return _history_in_both_modes(spark, folder, 2)


def scd2_three_loads(spark, folder):
    return _history_in_both_modes(spark, folder, 3)


def scd2_late_drop(spark, folder):
    """Order statuses after drops 1 and 3, into which drop 2 is spliced."""
    scratch, table = scratch_folder(spark), "sat_order_statuses"

    def drops(*numbers):
        return Chain(
            lambda feed, n: raw_feed(spark, folder, feed, numbers[n - 1]), lambda n: load_ts(numbers[n - 1]), LOAD_SRC,
            keep=lambda df, name: written(df, f"{scratch}/{'-'.join(map(str, numbers))}", name, CODEC))

    later = drops(3).source(table, 1).selectExpr("order_id", "load_dttm AS seen_ts", "load_src AS seen_src")
    target = written(drops(1, 3).vault(table, 2), scratch, "target")
    late = written(drops(2).source(table, 1), scratch, "late")
    return history.splice(target, late, later, ["order_id"], ["order_status"], load_ts(2)).select(*TABLES[table].columns)


def enrich_people(spark, folder):
    return _table(spark, folder, "customer").selectExpr(
        "c_custkey", f"{people.person_name('c_name')} AS customer_name",
        f"{people.email('c_name')} AS email", f"{people.phone_number('c_name')} AS phone_number",
        f"{people.birth_date('c_name')} AS date_of_birth")


def enrich_product_names(spark, folder):
    return _table(spark, folder, "part").selectExpr(
        "p_partkey", f"{people.product_name('p_partkey')} AS product_name")


# Quality ---------------------------------------------------------------------
def dq_pk_violations(spark, folder):
    return quality.key_violations(_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_null_violations(spark, folder):
    """Products without a category, original or English."""
    products = chain(spark, folder).staged("products", 2)
    return quality.null_violations(
        products.select("product_id", "category_name", "category_name_eng"),
        ["category_name", "category_name_eng"])


def dq_fk_orphans(spark, folder):
    """Orders of items that the order hub lacks: those sent twice, hence dropped."""
    c = chain(spark, folder)
    return quality.orphan_keys(
        c.staged("order_items", 2), "order_id", c.vault("hub_orders", 2), "order_id")


def dq_too_long(spark, folder):
    reviews = TABLES["reviews"]
    return quality.too_long(chain(spark, folder).staged("reviews", 2), reviews.key, reviews.max_bytes)


def dq_hash_collisions(spark, folder):
    """All hubs' business keys of both drops under a key cut to 8 bits, so that it does collide."""
    c, scratch, found = chain(spark, folder), scratch_folder(spark), []
    for job in vault.HUB_JOBS:
        drops = [staging.conform(job.source, c.prepared(job.source, n)) for n in (1, 2)]
        rows = vault.business_rows(job, drops[0].unionByName(drops[1]))
        [ref] = job.refs.values()
        keyed = rows.selectExpr(f"{hash_key(*ref.inputs(), digits=2)} AS id", *ref.columns)
        collisions = quality.hash_collisions(keyed, "id", ref.columns).selectExpr(
            f"'{job.table}' AS table_name", "id", "business_keys")
        found.append(written(collisions, scratch, job.table))  # hub by hub: eight small plans
    return reduce(DataFrame.unionByName, found)


def dq_merge_ambiguity(spark, folder):
    """Points that share the coarse merge key (zip code alone)."""
    return quality.merge_ambiguity(chain(spark, folder).staged("geolocation", 2), ["zip_code"])


def dq_declared_rules(spark, folder):
    """Every declared rule of all 36 tables, counted over both drops together (so keys
    repeat), in which some order items lack their order or price."""
    c, scratch = chain(spark, folder), scratch_folder(spark)
    c.prepare_together(staging.STAGING_TABLES, 2)  # each drop once, for the rules and the hubs
    drops = {t: [c.prepared_kept(t, n) for n in (1, 2)] for t in staging.STAGING_TABLES}
    drops["order_items"][0] = drops["order_items"][0].withColumns({
        "order_id": F.expr("CASE WHEN freight_value <> 13 THEN order_id END"),
        "price": F.expr("CASE WHEN freight_value <> 11 THEN price END")})
    feeds = {t: reduce(DataFrame.unionByName, both) for t, both in drops.items()}
    c.stage_together({job.source for job in vault.HUB_JOBS}, 2)

    def keep(df, name):
        return written(df, scratch, name, CODEC)

    tables = [job.table for job in vault.HUB_JOBS]
    with ThreadPoolExecutor(len(tables)) as pool:
        hubs = dict(zip(tables, pool.map(lambda t: keep(c.vault(t, 2), t), tables), strict=True))
    return rules.counted(feeds, hubs, keep)


def vault_rejects(spark, folder):
    """Rows of the second load that the vault's jobs leave out, with the reason."""
    c = chain(spark, folder)
    found = [
        vault.rejected_rows(job, c.staged_kept(job.source, 2), c.missing(t, 2)) for t, job in vault.JOBS.items()]
    return reduce(DataFrame.unionByName, filter(None, found))


# The load --------------------------------------------------------------------
def full_load(spark, folder):
    """Each order's current status with its customer and their current zip code,
    from the warehouse after two whole loads of all tables."""
    warehouse = Warehouse(spark, scratch_folder(spark))
    for n in (1, 2):
        feeds = {feed: raw_feed(spark, folder, feed, n) for feed in RAW_FEEDS}
        counts = run_load(spark, warehouse, feeds, Settings(load_ts(n), LOAD_SRC))
    links = warehouse.table("l_order_customer").selectExpr("order_id AS id", "customer_id")
    statuses = history.open_rows(warehouse.table("sat_order_statuses")).selectExpr(
        "order_id AS id", "order_status", "valid_from AS status_since")
    places = history.open_rows(warehouse.table("sat_customers_geolocation")).selectExpr(
        "customer_id", "zip_code", "valid_from AS zip_since")
    orders = warehouse.table("hub_orders").select("id", "order_id")
    places = dedup.bounded(places, counts["hub_customers"])
    return (
        orders.join(dedup.merged(statuses), "id").join(dedup.merged(links), "id").join(places, "customer_id")
        .select("order_id", "order_status", "status_since", "customer_id", "zip_code", "zip_since")
    )


def _checksums(spark, folder, buckets=None, ranges=None, **settings):
    """Rows and an order-free checksum of all 36 tables after loads 1, 2, 2 again, and 3."""
    warehouse = Warehouse(spark, scratch_folder(spark), buckets, ranges)
    for n in (1, 2, 2, 3):
        feeds = {feed: raw_feed(spark, folder, feed, n) for feed in RAW_FEEDS}
        run_load(spark, warehouse, feeds, Settings(load_ts(n), LOAD_SRC, **settings))
        warehouse.remove_superseded(attempts=True)
    newest = warehouse.snapshot()
    sums = [
        warehouse.table(name, newest).selectExpr(f"{hash_key(*t.columns, digits=8)} AS h")
        .selectExpr(
            f"'{name}' AS table_name", "count(*) AS row_count",
            "cast(sum(cast(h AS decimal(28, 0))) AS string) AS checksum")
        for name, t in TABLES.items()
    ]
    return reduce(DataFrame.unionByName, sums)


def load_tables(spark, folder):
    return _checksums(spark, folder)


def load_tables_bucketed(spark, folder):
    return _checksums(spark, folder, buckets=8)


def load_tables_wide(spark, folder):
    """The same with keys of 128 bits in all hubs, links and satellites."""
    return _checksums(spark, folder, key=HEX128)


RANGES = 64


def load_tables_changed(spark, folder):
    """The same where only changed rows are written: they carry the load that changed them."""
    return _checksums(spark, folder, ranges=RANGES)


def load_ranges(spark, folder):
    """How many of 64 key ranges of each upserted table three loads rewrite; the third has
    the feeds of the second."""
    warehouse, found = Warehouse(spark, scratch_folder(spark), ranges=RANGES), []
    for n, drop in ((1, 1), (2, 2), (3, 2)):
        feeds = {feed: raw_feed(spark, folder, feed, drop) for feed in RAW_FEEDS}
        run_load(spark, warehouse, feeds, Settings(load_ts(n), LOAD_SRC))
        warehouse.remove_superseded()
        state = warehouse.snapshot()
        found += [(n, t, warehouse.ranges_of(t, state.load_id, state)) for t in TABLES if warehouse.ranged(t)]
    return spark.createDataFrame(found, "load_no int, table_name string, ranges_rewritten int")


def load_rejects(spark, folder):
    """What two whole loads leave out of untidy order items, read from CSV: prices that
    are no numbers, items without an order or a price, and references to rows not sent. The
    second proves references that are new."""
    scratch = scratch_folder(spark)
    warehouse, ids = Warehouse(spark, f"{scratch}/warehouse"), (
        "order_id", "product_id", "seller_id", "customer_id", "review_id")
    found = []
    for n in (1, 2):
        feeds = {feed: raw_feed(spark, folder, feed, n) for feed in RAW_FEEDS}
        untidy = feeds["order_items"].selectExpr(
            "CASE WHEN freight_value <> 13 THEN order_id END AS order_id",
            "order_item_id", "product_id", "seller_id", "shipping_limit_date",
            "CASE WHEN freight_value = 7 THEN 'zz' WHEN freight_value <> 11 THEN cast(price AS string) END"
            " AS price", "freight_value")
        csv_files.write_csv(untidy, f"{scratch}/items{n}")
        feeds["order_items"], bad = csv_files.csv_scan(
            spark, f"{scratch}/items{n}", RAW_FEEDS["order_items"], multiline=False)
        settings = Settings(load_ts(n), LOAD_SRC, prove_once=True)
        run_load(spark, warehouse, feeds, settings, {"order_items": bad})
        found.append(warehouse.table(REJECTS).selectExpr(
            f"{n} AS load_no", "table_name", "reason", *[f"get_json_object(row, '$.{c}') AS {c}" for c in ids]))
    return reduce(DataFrame.unionByName, found)


def _prep_query(feed: str) -> Query:
    """The feed's cleaned rows of both drops, which together hold every source row."""
    def query(spark, folder):
        c = chain(spark, folder)
        return reduce(DataFrame.unionByName, [
            c.prepared(feed, n).withColumn("load_no", F.lit(n)) for n in (1, 2)])
    return query


def _staging_query(table: str) -> Query:
    return lambda spark, folder: chain(spark, folder).staged(table, 2)


def _vault_query(table: str) -> Query:
    return lambda spark, folder: chain(spark, folder).vault(table, loads_shown(table))


_PREP_NAMES = {feed: f"prep_{feed}" for feed in RAW_FEEDS if feed != "translation"}
_PREP_NAMES["geolocation"] = "prep_geolocations"


def all_queries() -> dict[str, Query]:
    named = [
        full_load, load_tables, load_tables_bucketed, load_tables_wide, load_tables_changed, load_ranges,
        load_rejects, dq_declared_rules,
        csv_scan, csv_roundtrip, typed_load_good, typed_load_rejects, load_counts,
        append_batch, dedup_drop_all, union_all, distinct_rows, hash_key_1, hash_key_n,
        merge_upsert, merge_insert_only, scd2_changed_keys, scd2_two_loads, scd2_three_loads, scd2_late_drop,
        enrich_people, enrich_product_names, dq_pk_violations, dq_null_violations,
        dq_fk_orphans, dq_too_long, dq_hash_collisions, dq_merge_ambiguity, vault_rejects,
    ]
    found: dict[str, Query] = {f.__name__: f for f in named}
    found.update({name: _prep_query(feed) for feed, name in _PREP_NAMES.items()})
    found.update({f"stg_{t}": _staging_query(t) for t in staging.STAGING_TABLES})
    found.update({t: _vault_query(t) for t in vault.JOBS})
    return found
