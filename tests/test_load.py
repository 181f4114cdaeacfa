"""The whole load on small hand-written CSV drops."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vaultloom.plans import pipeline, vault
from vaultloom.plans.pipeline import LoadError, Settings, read_feeds, run_load
from vaultloom.sources.tables import RAW_FEEDS, TABLES
from vaultloom.sources.warehouse import INSERT_ONLY, LEDGER, REJECTS, Warehouse, create_tables

AT = "2024-01-01 10:00:00"
DROP = {
    "customers": ["c1,u1,100,santa bárbara d'oeste,SP", "c2,u2,200,embu-guacu,SP",
                  "c3,u3,300,x,RJ", "c3,u3,301,y,RJ"],
    "geolocation": ["100,-22.5,-47.25,santa bárbara d'oeste,SP", "100,-22.75,-47.25,santa bárbara d'oeste,SP",
                    "200,-23.5,-46.5,embu-guacu,SP", "300,1.5,2.5,x,RJ", "300,1.5,2.5,x,RJ"],
    "orders": [f"o1,c1,delivered,{AT},{AT},{AT},{AT},{AT}", f"o2,c2,shipped,{AT},,,,{AT}",
               f"o3,c9,shipped,{AT},,,,{AT}"],
    "products": ["p1,cama_mesa,1,1,1,100,1.5,2,3", "p2,casa,1,1,1,200,1.5,2,3",
                 "p3,,1,1,1,,1.5,2,3", "p4,sem_nome,1,1,1,10,1,1,1"],
    "translation": ["cama_mesa,bed_bath", "casa,bed_bath"],
    "sellers": ["s1,100,rio 2a x,RJ", "s2,200,MOJI MIRIM,SP"],
    "order_items": [f"o1,1,p1,s1,{AT},10.50,1.25", f"o1,2,p1,s1,{AT},10.50,1.25",
                    f"o2,1,p3,s2,{AT},7.99,", f"o2,2,p9,s2,{AT},1.00,1.00"],
    "payments": ["o1,1,credit_card,3,22.5", "o2,1,boleto,1,9.0"],
    "reviews": [f'r1,o1,5,good,"nice, ""very""\nnice",{AT},{AT}', f"r2,o2,3,,,{AT},{AT}",
                f"r3,o7,1,,bad,{AT},{AT}"],
}


def write_drop(folder, changes=None):
    folder.mkdir()
    for feed, lines in {**DROP, **(changes or {})}.items():
        text = "\n".join([",".join(RAW_FEEDS[feed].names), *lines]) + "\n"
        (folder / f"{feed}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def load(spark, wh, folder, n, **options):
    good, rejects = read_feeds(spark, folder)
    assert all(r.isEmpty() for r in rejects.values())
    return run_load(spark, wh, good, Settings(f"2024-01-0{n} 01:00:00", "test-feeds", **options))


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def all_rows(wh):
    return {t: rows(wh.table(t), *TABLES[t].columns) for t in TABLES}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("drops")
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    first = write_drop(folder / "1")
    second = write_drop(folder / "2", {
        "customers": ["c1,u1,111,santa bárbara d'oeste,SP", "c2,u2,200,embu-guacu,SP", "c4,u4,400,z,RJ"],
        "orders": [f"o1,c1,delivered,{AT},{AT},{AT},{AT},{AT}", f"o2,c2,delivered,{AT},,,,{AT}"],
    })
    load(spark, wh, first, 1)
    after_first = all_rows(wh)
    rejected = rows(wh.table(REJECTS), "table_name", "reason")
    load(spark, wh, first, 1)
    repeated = all_rows(wh)
    load(spark, wh, second, 2)
    after_second = all_rows(wh)
    load(spark, wh, second, 2)
    return wh, after_first, repeated, after_second, all_rows(wh), rejected, first


def test_repeating_a_load_changes_nothing(loaded):
    _, after_first, repeated, after_second, repeated_second, _, _ = loaded
    assert repeated == after_first
    assert repeated_second == after_second


def test_cleaning(loaded):
    wh = loaded[0]
    assert set(rows(wh.table("customers"), "customer_id", "city")) == {
        ("c1", "Santa Bárbara D'Oeste"), ("c2", "Embu-Guacu"), ("c4", "Z")}
    assert set(rows(wh.table("sellers"), "city")) == {("Rio 2A X",), ("Moji Mirim",)}
    assert set(rows(wh.table("products"), "product_id", "category_name", "category_name_eng")) == {
        ("p1", "Cama mesa", "Bed bath"), ("p2", "Casa", "Bed bath"), ("p3", None, None),
        ("p4", "Sem nome", None)}
    assert rows(wh.table("payments"), "payment_type") == Counter([("Credit Card",), ("Boleto",)])
    assert set(rows(wh.table("reviews"), "review_id", "comment_message", "is_commented")) == {
        ("r1", 'nice, "very"\nnice', True), ("r2", None, False), ("r3", "bad", True)}
    assert wh.table("geolocation").count() == 3


def test_null_category_has_a_hub_row_and_a_link_but_no_satellite(loaded):
    wh = loaded[0]
    assert wh.table("hub_categories").count() == 2
    assert wh.table("l_product_category").count() == 4
    assert rows(wh.table("sat_category"), "category_name", "category_name_origin") == Counter(
        [("Bed bath", "Cama mesa")])


def test_history(loaded):
    wh = loaded[0]
    hub = wh.table("hub_customers").withColumnRenamed("customer_id", "bk")
    places = wh.table("sat_customers_geolocation").join(hub.selectExpr("id AS customer_id", "bk"), "customer_id")
    got = {(r.bk, r.zip_code, r.valid_from.day, r.valid_to and r.valid_to.day) for r in places.collect()}
    assert got == {("c1", 100, 1, 2), ("c1", 111, 2, None), ("c2", 200, 1, None), ("c4", 400, 2, None)}


def test_orphans_are_rejected_and_never_linked(loaded):
    wh, rejected = loaded[0], loaded[5]
    assert rejected == Counter([
        ("l_order_customer", "no hub_customers row"), ("l_product_seller", "no hub_products row"),
        ("l_review_order", "no hub_orders row"), ("l_order_items", "no hub_products row")])
    for t in TABLES.values():
        for column, hub in t.parents.items():
            orphans = wh.table(t.name).join(
                wh.table(hub).selectExpr(f"id AS {column}"), column, "left_anti")
            assert orphans.isEmpty(), (t.name, column)


def test_keys_are_unique_and_required_columns_filled(loaded):
    wh = loaded[0]
    for t in TABLES.values():
        df = wh.table(t.name)
        if "valid_to" in t.columns:
            df = df.filter("valid_to IS NULL")
        assert df.groupBy(*t.key).count().filter("count > 1").isEmpty(), t.name
        assert df.dropna(subset=t.required).count() == df.count(), t.name


def test_strict_load_publishes_nothing_on_rejects(spark, loaded, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "strict"))
    with pytest.raises(LoadError):
        load(spark, wh, loaded[6], 1, strict=True)
    assert wh.snapshot().tables == {}


def test_strict_load_of_clean_feeds_equals_the_plain_one(spark, tmp_path):
    clean = write_drop(tmp_path / "drop", {
        "orders": DROP["orders"][:2], "order_items": DROP["order_items"][:3],
        "reviews": DROP["reviews"][:2]})
    plain, strict = Warehouse(spark, str(tmp_path / "a")), Warehouse(spark, str(tmp_path / "b"), buckets=4)
    load(spark, plain, clean, 1)
    load(spark, strict, clean, 1, strict=True)
    assert all_rows(plain) == all_rows(strict)
    assert strict.table(REJECTS).isEmpty()


def test_two_rows_for_one_merge_key_stop_the_load(spark, tmp_path):
    folder = write_drop(tmp_path / "drop", {"payments": ["o1,1,boleto,1,1.0", "o1,1,boleto,1,2.0"]})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(LoadError, match="payments"):
        load(spark, wh, folder, 1)


def test_older_load_is_refused(loaded):
    with pytest.raises(ValueError):
        loaded[0].begin("2023-12-31 01:00:00")


def test_first_seen_keeps_the_first_audit_columns(spark, loaded, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for n in (1, 2):
        load(spark, wh, loaded[6], n, first_seen=True)
    assert {r.load_dttm.day for r in wh.table("hub_orders").collect()} == {1}
    assert {r.load_dttm.day for r in wh.table("sat_order_details").collect()} == {2}


def test_compaction_keeps_the_rows(spark, loaded, tmp_path):
    good, _ = read_feeds(spark, loaded[6])
    plain, compact = (Warehouse(spark, str(tmp_path / n)) for n in ("plain", "compact"))
    for n in (1, 2):
        moved = {**good, "customers": good["customers"].selectExpr(
            "customer_id", "customer_unique_id", f"customer_zip_code_prefix + {n} AS customer_zip_code_prefix",
            "customer_city", "customer_state")}
        for wh in (plain, compact):
            run_load(spark, wh, moved, Settings(f"2024-01-0{n} 01:00:00", "x"))
    pipeline.compact(compact)
    assert all_rows(plain) == all_rows(compact)
    folders = {wh: len(wh.snapshot().tables["sat_customers_geolocation"]) for wh in (plain, compact)}
    assert folders == {plain: 2, compact: 1}
    assert len(plain.snapshot().tables["hub_cities"]) == 1


def test_prepared_files(spark, loaded, tmp_path):
    good, _ = read_feeds(spark, loaded[6])
    from vaultloom.plans.prep import prepare_all
    pipeline.write_prepared(prepare_all(good), str(tmp_path / "prepared"))
    back, rejects = pipeline.read_prepared(spark, str(tmp_path / "prepared"))
    assert all(r.isEmpty() for r in rejects.values())
    assert back["reviews"].count() == 3 and back["customers"].count() == 2


def test_empty_tables_are_created_with_constraints(spark):
    create_tables(spark, "vault_test", ["hub_orders", "l_order_items"])
    schema = spark.table("vault_test.l_order_items").schema
    assert schema["price"].dataType.simpleString() == "decimal(10,2)"
    assert spark.table("vault_test.hub_orders").count() == 0
    spark.sql("DROP DATABASE vault_test CASCADE")


def test_every_table_has_a_job():
    assert set(vault.JOBS) == {t.name for t in TABLES.values() if t.layer != "staging"}


def test_announced_drops_are_loaded_once_and_in_order(spark, tmp_path):
    from vaultloom.streaming.drops import load_drops

    wh = Warehouse(spark, str(tmp_path / "wh"))
    notes = tmp_path / "announced"
    notes.mkdir()
    settings = Settings("", "test-feeds")

    def run(n, changes=None):
        folder = write_drop(tmp_path / f"drop{n}", changes)
        (notes / f"{n}.json").write_text(f'{{"load_ts": "2024-01-0{n} 01:00:00", "folder": "{folder}"}}')
        load_drops(spark, wh, str(notes), str(tmp_path / "checkpoint"), settings).awaitTermination()

    run(1)
    run(2, {"orders": [f"o1,c1,shipped,{AT},{AT},{AT},{AT},{AT}"]})
    assert wh.spark.read.json(f"{wh.root}/commits").count() == 2
    statuses = wh.table("sat_order_statuses")
    assert rows(statuses.filter("valid_to IS NOT NULL"), "order_status") == Counter([("Delivered",)])
    assert rows(statuses.filter("valid_to IS NULL"), "order_status") == Counter([("Shipped",)] * 3)


def test_a_late_or_doubled_announcement_stops_the_stream(spark, tmp_path, feeds):
    from vaultloom.streaming.drops import load_drops

    def announce(n, *drops):
        lines = [json.dumps({"load_ts": f"2024-01-0{d} 01:00:00", "folder": f"{tmp_path}/drop{f}"}) for d, f in drops]
        (tmp_path / "news").mkdir(exist_ok=True)
        (tmp_path / "news" / f"{n}.json").write_text("\n".join(lines))

    def run(name):
        wh = Warehouse(spark, str(tmp_path / name))
        load_drops(spark, wh, str(tmp_path / "news"), str(tmp_path / f"{name}-mark"),
                   Settings("", "x")).awaitTermination()

    announce(1, (1, 1), (1, 2))
    with pytest.raises(Exception, match="two folders"):
        run("doubled")


def test_null_keys_and_bad_cells_are_rejected(spark, tmp_path, feeds):
    broken = dict(feeds)
    broken["orders"] = feeds["orders"].unionByName(
        feeds["orders"].limit(1).withColumn("order_id", F.lit(None).cast("string")))
    cells = spark.createDataFrame([("O1", "zz", "price")], "order_id string, price string, bad_columns string")
    wh = Warehouse(spark, str(tmp_path / "plain"))
    run_load(spark, wh, broken, Settings("2024-01-01 01:00:00", "x"), {"order_items": cells})
    found = {(r.table_name, r.reason) for r in wh.table(REJECTS).collect()}
    assert ("orders", "missing order_id") in found and ("order_items", "bad cells price") in found
    for c in ("review_comment_title", "review_comment_message"):
        broken["reviews"] = broken["reviews"].withColumn(c, F.substring(c, 1, 9))
    with pytest.raises(LoadError, match="rejected"):
        run_load(spark, Warehouse(spark, str(tmp_path / "strict")), broken,
                 Settings("2024-01-01 01:00:00", "x", strict=True), {"order_items": cells})


def test_a_doubled_translation_fails_the_load(spark, tmp_path, feeds):
    broken = {**feeds, "translation": feeds["translation"].unionByName(feeds["translation"])}
    with pytest.raises(LoadError, match="translation"):
        run_load(spark, Warehouse(spark, str(tmp_path)), broken, Settings("2024-01-01 01:00:00", "x"))


def test_a_load_over_a_stale_base_is_refused(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    first, second = wh.begin("2024-1-2"), wh.begin("2024-01-02 00:00:00")
    assert first.load_id == second.load_id < wh.begin("2024-01-03").load_id
    first.commit()
    with pytest.raises(RuntimeError, match="meanwhile"):
        second.commit()


@pytest.fixture
def feeds(spark):
    from vaultloom.sources.sample_feeds import FEEDS, raw_feed

    return {f: raw_feed(spark, "/root/testdata/sf0.001", f, 1) for f in FEEDS}


def test_colliding_hub_ids_fail_every_load(spark, tmp_path, feeds, monkeypatch):
    monkeypatch.setattr(vault.Ref, "expression", lambda ref, key="": "1L")
    wh = Warehouse(spark, str(tmp_path / "collision"))
    with pytest.raises(LoadError, match="one id stands for several business keys"):
        run_load(spark, wh, feeds, Settings("2024-01-01 01:00:00", "x"))
    assert wh.snapshot().tables == {}


@pytest.mark.parametrize("buckets", [None, 2])
def test_removal_spares_what_newer_loads_name(spark, loaded, tmp_path, buckets):
    from pathlib import Path

    wh = Warehouse(spark, str(tmp_path / "wh"), buckets)
    assert wh.remove_superseded() == []
    for n in (1, 2, 3):
        load(spark, wh, loaded[6], n)
    before, first = all_rows(wh), "20240101"
    gone = wh.remove_superseded()
    data = [g for g in gone if "/wh/data/" in g]
    assert any(f"/{first}" in g for g in data)
    later = {g.split("/")[-2] for g in data if first not in g}
    ledgers = {LEDGER + t for t in INSERT_ONLY}
    assert later <= ledgers | set(INSERT_ONLY)  # the empty deltas of load 2, which it doesn't name
    assert not any(Path(g).exists() for g in gone)
    assert Path(wh.snapshot().tables["hub_cities"][0]).name.startswith(first)  # insert-only: still named
    assert all_rows(wh) == before
    load(spark, wh, loaded[6], 3)
    assert all_rows(wh) == before and wh.remove_superseded() == []
    with pytest.raises(ValueError):
        wh.remove_superseded(1)


def test_a_drop_announced_late_stops_the_stream(spark, tmp_path):
    from vaultloom.streaming.drops import load_drops

    wh, notes = Warehouse(spark, str(tmp_path / "wh")), tmp_path / "announced"
    notes.mkdir()

    def announce(n):
        folder = write_drop(tmp_path / f"drop{n}")
        (notes / f"{n}.json").write_text(f'{{"load_ts": "2024-01-0{n} 01:00:00", "folder": "{folder}"}}')
        load_drops(spark, wh, str(notes), str(tmp_path / "checkpoint"), Settings("", "x")).awaitTermination()

    announce(2)
    with pytest.raises(Exception, match="after a later one"):
        announce(1)
    assert len(wh.loaded()) == 1


def test_a_collision_with_a_key_that_left_staging_fails_the_load(spark, tmp_path, monkeypatch):
    real = vault.Ref.expression
    monkeypatch.setattr(vault.Ref, "expression", lambda ref, key="int60": "7L" if ref == vault.CITY else real(ref, key))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    only = {"customers": DROP["customers"][:2], "orders": DROP["orders"][:2]}
    first = write_drop(tmp_path / "1", {**only, "geolocation": ["100,-22.5,-47.25,one,SP", "200,-23.5,-46.5,one,SP"]})
    load(spark, wh, first, 1)
    load(spark, wh, first, 2)  # the same key again is no collision
    assert rows(wh.table("hub_cities"), "id") == Counter([(7,)])
    renamed = write_drop(tmp_path / "2", {**only, "geolocation": ["100,-22.5,-47.25,two,SP", "200,-23.5,-46.5,two,SP"]})
    with pytest.raises(LoadError, match="hub_cities: one id stands for several"):
        load(spark, wh, renamed, 3)
    assert wh.snapshot().load_id.startswith("20240102")


def test_a_clean_load_scans_nothing_for_rejects(spark, tmp_path):
    from tests.test_placed import write_plans

    clean = write_drop(tmp_path / "drop", {
        "orders": DROP["orders"][:2], "order_items": DROP["order_items"][:3], "reviews": DROP["reviews"][:2]})
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load(spark, wh, clean, 1)
    [plan] = write_plans(spark, "rejects/" + wh.snapshot().tables[REJECTS][0].rsplit("/", 1)[1])
    assert "Scan parquet" not in plan, plan


def test_wide_keys(spark, loaded, tmp_path):
    """A load with 128-bit keys holds the same rows under other ids, and its warehouse takes no others."""
    wide = Warehouse(spark, str(tmp_path / "wide"), buckets=2)
    load(spark, wide, loaded[6], 1, key="hex128")
    plain = Warehouse(spark, str(tmp_path / "plain"))
    load(spark, plain, loaded[6], 1)
    for name, t in TABLES.items():
        ids = set(t.hash_keys)
        others = [c for c in t.columns if c not in ids]
        assert rows(wide.table(name), *others) == rows(plain.table(name), *others), name
        assert all(wide.table(name).filter(f"length({c}) <> 32 OR {c} IS NULL").isEmpty() for c in ids), name
    hub, status = wide.table("hub_orders"), wide.table("sat_order_statuses")
    assert hub.join(status, hub.id == status.order_id).count() == status.count() == 3
    load(spark, wide, loaded[6], 2, key="hex128")
    with pytest.raises(ValueError, match="hex128, not int60"):
        load(spark, wide, loaded[6], 3)
    with pytest.raises(ValueError, match="int60, not hex128"):
        load(spark, plain, loaded[6], 2, key="hex128")
    with pytest.raises(ValueError, match="unknown kind"):
        load(spark, Warehouse(spark, str(tmp_path / "none")), loaded[6], 1, key="hex64")


def test_references_are_proved_once(spark, loaded, tmp_path):
    from tests.test_placed import write_plans

    wh = Warehouse(spark, str(tmp_path / "wh"))
    load(spark, wh, loaded[6], 1, prove_once=True)
    proved = "proved_of_l_order_customer_customer_id"
    first, held = wh.snapshot(), wh.spark.read.parquet(*wh.snapshot().tables[proved])
    assert rows(held, "id") == rows(wh.table("hub_customers").filter("customer_id <> 'c9'"), "id")
    rejected = rows(wh.table(REJECTS), "table_name", "reason", "row")
    late = write_drop(tmp_path / "late", {  # the missing customer comes, another is missing
        "customers": [*DROP["customers"][:2], "c9,u9,900,q,SP"],
        "orders": [*DROP["orders"], f"o4,c8,shipped,{AT},,,,{AT}"]})
    load(spark, wh, late, 2, prove_once=True)
    second = wh.snapshot().tables[proved]
    assert len(second) == 2 and wh.spark.read.parquet(second[1]).count() == 1  # c9 alone
    assert all(second_paths == first.tables[t] for t, second_paths in wh.snapshot().tables.items()
               if t.startswith("proved_of_l_product_seller"))
    attempt = second[1].rsplit("/", 1)[1]
    [plan] = write_plans(spark, f"{attempt}/l_order_customer.customer_id.held")
    assert "Broadcast" in plan and "Exchange hashpartitioning" not in plan, plan
    now = rows(wh.table(REJECTS), "table_name", "reason", "row")
    assert ("l_order_customer", "no hub_customers row", '{"customer_id":"c8","order_id":"o4"}') in now
    assert not any("c9" in row for _, _, row in now) and any("c9" in row for _, _, row in rejected)
    assert wh.table("l_order_customer").count() == 3
