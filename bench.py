"""Timings of the headline jobs; prints one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default 8)

Queries are timed to the last row (written to the ``noop`` sink), including the
writing of shared states. ``load_first`` and ``load_second`` are whole loads of
36 tables into a warehouse on disk, ``load_csv`` is the first one from raw CSV files,
and ``history_5_loads`` is the history merge over five drops.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tests.session import make_session
from vaultloom.plans.pipeline import Settings, read_feeds, run_load
from vaultloom.registry.queries import LOAD_SRC, all_queries, chain, load_ts
from vaultloom.sources.csv_files import write_csv
from vaultloom.sources.sample_feeds import FEEDS, raw_feed
from vaultloom.sources.scratch import scratch_folder
from vaultloom.sources.warehouse import Warehouse

HEADLINE = [
    "full_load", "csv_roundtrip", "typed_load_good", "dedup_drop_all", "prep_customers",
    "prep_products", "prep_reviews", "stg_orders", "stg_order_items", "stg_geolocation",
    "hub_orders", "hub_cities", "l_order_customer", "l_product_seller", "l_order_items",
    "sat_order_details", "sat_category", "sat_order_statuses", "scd2_three_loads",
    "merge_upsert", "merge_insert_only", "hash_key_n", "dq_fk_orphans",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.time()
    work()
    return round(time.time() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = make_session(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    drain(queries["hash_key_1"](spark, folder))  # starts the session and its code paths

    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda: drain(queries[name](spark, folder)))
        print(name, seconds[name], file=sys.stderr, flush=True)

    warehouse = Warehouse(spark, scratch_folder(spark))
    for n, name in ((1, "load_first"), (2, "load_second")):
        feeds = {f: raw_feed(spark, folder, f, n) for f in FEEDS}
        seconds[name] = timed(
            lambda: run_load(spark, warehouse, feeds, Settings(load_ts(n), LOAD_SRC)))
        print(name, seconds[name], file=sys.stderr, flush=True)
    scratch = scratch_folder(spark)
    for f, df in {f: raw_feed(spark, folder, f, 1) for f in FEEDS}.items():
        write_csv(df, f"{scratch}/{f}.csv")

    def from_csv():
        good, rejected = read_feeds(spark, scratch)
        run_load(spark, Warehouse(spark, f"{scratch}/csv"), good, Settings(load_ts(1), LOAD_SRC), rejected)

    seconds["load_csv"] = timed(from_csv)
    print("load_csv", seconds["load_csv"], file=sys.stderr, flush=True)
    seconds["history_5_loads"] = timed(
        lambda: drain(chain(spark, folder).vault("sat_order_statuses", 5)))

    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
