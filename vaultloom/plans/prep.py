"""Cleaning jobs: raw feed in, prepared feed out with the staging column names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from vaultloom.functions import people
from vaultloom.functions.text import capitalize, title_case, underscores_to_spaces
from vaultloom.operators.dedup import drop_all_duplicates
from vaultloom.sources.tables import TABLES

# Raw columns whose duplicated values are dropped with all their rows.
DEDUP_KEYS = {
    "customers": ["customer_id"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "reviews": ["review_id"],
}


TRANSLATION_KEY = ["product_category_name"]  # proved unique before products are joined


def _renamed(df: DataFrame, table: str, **names: str) -> DataFrame:
    """The staging columns by name; ``names`` gives the SQL text where it differs."""
    return df.selectExpr(*[f"{names.get(c, c)} AS {c}" for c in TABLES[table].columns])


def customers(raw: DataFrame) -> DataFrame:
    return _renamed(
        raw, "customers",
        customer_name=people.person_name("customer_id"),
        email=people.email("customer_id"),
        phone_number=people.phone_number("customer_id"),
        date_of_birth=people.birth_date("customer_id"),
        zip_code="customer_zip_code_prefix",
        city=title_case("customer_city"),
        state="customer_state",
    )


def geolocation(raw: DataFrame) -> DataFrame:
    return _renamed(
        raw, "geolocation",
        zip_code="geolocation_zip_code_prefix",
        latitude="geolocation_lat",
        longitude="geolocation_lng",
        city=title_case("geolocation_city"),
        state="geolocation_state",
    )


def orders(raw: DataFrame) -> DataFrame:
    return _renamed(raw, "orders", order_status=capitalize("order_status"))


def products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """The translation is a lookup of a few dozen rows in a file of its own; the
    planner sees its size and broadcasts it, or sorts and merges if it has grown."""
    return _renamed(
        raw.join(translation, "product_category_name", "left"), "products",
        category_name=capitalize(underscores_to_spaces("product_category_name")),
        category_name_eng=capitalize(underscores_to_spaces("product_category_name_english")),
        product_name=people.product_name("product_id"),
        weight_g="product_weight_g",
        length_cm="product_length_cm",
        height_cm="product_height_cm",
        width_cm="product_width_cm",
    )


def sellers(raw: DataFrame) -> DataFrame:
    return _renamed(
        raw, "sellers",
        zip_code="seller_zip_code_prefix",
        city=title_case("seller_city"),
        state="seller_state",
        email=people.email("seller_id"),
        phone_number=people.phone_number("seller_id"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    return _renamed(raw, "order_items")


def payments(raw: DataFrame) -> DataFrame:
    kind = title_case(underscores_to_spaces("payment_type"))
    return _renamed(raw, "payments", payment_type=kind)


def reviews(raw: DataFrame) -> DataFrame:
    return _renamed(
        raw, "reviews",
        comment_title="review_comment_title",
        comment_message="review_comment_message",
        creation_date="review_creation_date",
        answer_timestamp="review_answer_timestamp",
        is_commented="review_comment_message IS NOT NULL",
    )


_CLEANERS = {
    "customers": customers,
    "geolocation": geolocation,
    "orders": orders,
    "sellers": sellers,
    "order_items": order_items,
    "payments": payments,
    "reviews": reviews,
}


def prepare(
    feed: str,
    raw: DataFrame,
    translation: DataFrame | None = None,
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """Drop duplicated keys, then clean. ``duplicates``: see ``drop_all_duplicates``."""
    keys = DEDUP_KEYS.get(feed)
    unique = drop_all_duplicates(raw, keys, duplicates) if keys else raw
    if feed == "products":
        return products(unique, translation)
    return _CLEANERS[feed](unique)


def prepare_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        feed: prepare(feed, df, translation=raw.get("translation"))
        for feed, df in raw.items()
        if feed != "translation"
    }
