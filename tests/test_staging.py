from datetime import datetime

from vaultloom.plans import staging
from vaultloom.sources.tables import TABLES


def test_times_are_rounded_to_seconds_in_any_time_zone(spark):
    # The second time does not exist in the session's zone: clocks went forward.
    times = ["2024-01-01 10:00:00.499999", "1995-10-15 00:00:00", "2024-12-31 23:59:59.5",
             "1969-12-31 23:59:58.75", None]
    columns = [c for c in TABLES["orders"].columns if c not in ("order_id", "order_purchase_timestamp")]
    raw = spark.createDataFrame(list(enumerate(times)), "i int, t string").selectExpr(
        "concat('o', i) AS order_id", "cast(t AS timestamp_ntz) AS order_purchase_timestamp",
        *[f"cast(NULL AS {TABLES['orders'].plain_schema[c].dataType.simpleString()}) AS {c}" for c in columns])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = [r.order_purchase_timestamp for r in staging.stage_rows("orders", raw).orderBy("order_id").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [datetime(2024, 1, 1, 10), datetime(1995, 10, 15), datetime(2025, 1, 1),
                   datetime(1969, 12, 31, 23, 59, 59), None]


def test_rows_without_a_required_key_are_left_out(spark):
    raw = spark.createDataFrame(
        [("s1", 1, "a", "b", "e", "p"), (None, 2, "a", "b", "e", "p")],
        "seller_id string, zip_code int, city string, state string, email string, phone_number string")
    assert [r.seller_id for r in staging.stage_rows("sellers", raw).collect()] == ["s1"]


def test_null_parts_of_a_staging_key_match(spark):
    drop = spark.createDataFrame(
        [("o1", None, "Boleto", 1, 2.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    once = staging.load_staging("payments", None, drop)
    assert staging.load_staging("payments", once, drop).count() == 1
