"""Definitions of the 36 warehouse tables and the 9 raw feeds.

Names, types, lengths and constraints are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VarcharType,
)

STAGING, HUB, LINK, SATELLITE = "staging", "hub", "link", "satellite"

_KEY = LongType()
_INT = IntegerType()
_NUM = DoubleType()
_MONEY = DecimalType(10, 2)
_TIME = TimestampNTZType()
_S50, _S100, _S300 = VarcharType(50), VarcharType(100), VarcharType(300)


@dataclass(frozen=True)
class Table:
    name: str
    layer: str
    key: tuple[str, ...]
    schema: StructType
    parents: dict[str, str] = field(default_factory=dict)  # column -> hub

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def max_bytes(self) -> dict[str, int]:
        return {f.name: f.dataType.length for f in self.schema if isinstance(f.dataType, VarcharType)}

    @property
    def plain_schema(self) -> StructType:
        """The schema as DataFrames carry it: strings without a declared length."""
        return self.schema_with(LongType())

    def schema_with(self, key_type: DataType) -> StructType:
        """The plain schema with hash keys of this type."""
        return StructType([
            StructField(f.name, key_type if f.name in self.hash_keys else plain(f.dataType), True) for f in self.schema])

    @property
    def hash_keys(self) -> list[str]:
        """Columns that hold a hash key: ids of hubs, and of rows that combine several."""
        if self.layer == STAGING:
            return []
        return [f.name for f in self.schema if isinstance(f.dataType, LongType) and not f.nullable]


def plain(t: DataType) -> DataType:
    return StringType() if isinstance(t, VarcharType) else t


_TABLES: dict[str, Table] = {}


def _define(name, layer, key, columns, parents=None):
    """``columns`` maps a name to its type, or to ``(type,)`` where NOT NULL."""
    schema = StructType([
        StructField(c, t[0], False) if isinstance(t, tuple) else StructField(c, t, True)
        for c, t in columns.items()
    ])
    _TABLES[name] = Table(name, layer, tuple(key.split()), schema, parents or {})


def _audited(columns):
    return {**columns, "load_dttm": (_TIME,), "load_src": (_S50,)}


def _hub(name, business_key=None):
    columns = {"id": (_KEY,)}
    if business_key:
        columns[business_key] = (_S100,)
    _define(name, HUB, "id", _audited(columns))


def _link(name, key, columns, parents):
    _define(name, LINK, key, _audited(columns), parents)


def _satellite(name, hub, key, columns, history=False):
    columns = {key: (_KEY,), **columns}
    if history:
        columns.update(valid_from=(_TIME,), valid_to=_TIME)
    _define(name, SATELLITE, key, _audited(columns), {key: hub})


# Staging -------------------------------------------------------------------
_define("products", STAGING, "product_id", {
    "product_id": (_S100,), "category_name": _S100, "category_name_eng": _S100,
    "product_name": _S100, "weight_g": _NUM, "length_cm": _NUM, "height_cm": _NUM,
    "width_cm": _NUM,
})
_define("customers", STAGING, "customer_id", {
    "customer_id": (_S100,), "customer_unique_id": _S100, "customer_name": _S100,
    "email": _S100, "phone_number": _S100, "date_of_birth": DateType(), "zip_code": _INT,
    "city": _S100, "state": _S50,
})
_define("geolocation", STAGING, "zip_code latitude longitude", {
    "zip_code": (_INT,), "latitude": _NUM, "longitude": _NUM, "city": _S100, "state": _S50,
})
_define("sellers", STAGING, "seller_id", {
    "seller_id": (_S100,), "zip_code": _INT, "city": _S100, "state": _S50, "email": _S100,
    "phone_number": _S100,
})
_define("reviews", STAGING, "review_id", {
    "review_id": (_S100,), "order_id": _S100, "review_score": _INT, "comment_title": _S100,
    "comment_message": _S300, "creation_date": _TIME, "answer_timestamp": _TIME,
    "is_commented": BooleanType(),
})
_define("payments", STAGING, "order_id payment_sequential", {
    "order_id": (_S100,), "payment_sequential": _INT, "payment_type": _S100,
    "payment_installments": _INT, "payment_value": _NUM,
})
_define("order_items", STAGING, "order_id order_item_id", {
    "order_id": (_S100,), "order_item_id": LongType(), "product_id": _S100,
    "seller_id": _S100, "shipping_limit_date": _TIME, "price": _NUM, "freight_value": _NUM,
})
_define("orders", STAGING, "order_id", {
    "order_id": (_S100,), "customer_id": _S100, "order_status": _S50,
    "order_purchase_timestamp": _TIME, "order_approved_at": _TIME,
    "order_delivered_carrier_date": _TIME, "order_delivered_customer_date": _TIME,
    "order_estimated_delivery_date": _TIME,
})

# Hubs ----------------------------------------------------------------------
_hub("hub_customers", "customer_id")
_hub("hub_orders", "order_id")
_hub("hub_products", "product_id")
_hub("hub_categories")
_hub("hub_sellers", "seller_id")
_hub("hub_reviews", "review_id")
_hub("hub_geolocations")
_hub("hub_cities")

# Links ---------------------------------------------------------------------
_link("l_order_customer", "order_id customer_id",
      {"order_id": (_KEY,), "customer_id": (_KEY,)},
      {"order_id": "hub_orders", "customer_id": "hub_customers"})
_link("l_customer_geolocation", "customer_id",
      {"customer_id": (_KEY,), "zip_code": (_INT,)}, {"customer_id": "hub_customers"})
_link("l_geolocation_city", "id",
      {"id": (_KEY,), "city_id": (_KEY,), "zip_code": (_INT,)}, {"city_id": "hub_cities"})
_link("l_seller_geolocation", "seller_id",
      {"seller_id": (_KEY,), "zip_code": (_INT,)}, {"seller_id": "hub_sellers"})
_link("l_product_seller", "product_id seller_id",
      {"product_id": (_KEY,), "seller_id": (_KEY,)},
      {"product_id": "hub_products", "seller_id": "hub_sellers"})
_link("l_product_category", "product_id category_id",
      {"product_id": (_KEY,), "category_id": (_KEY,)},
      {"product_id": "hub_products", "category_id": "hub_categories"})
_link("l_review_order", "review_id order_id",
      {"review_id": (_KEY,), "order_id": (_KEY,)},
      {"review_id": "hub_reviews", "order_id": "hub_orders"})
_link("l_order_items", "order_item_id",
      {"order_item_id": (_KEY,), "product_id": (_KEY,), "order_id": (_KEY,),
       "order_item_num": LongType(), "price": (_MONEY,), "freight_value": _MONEY},
      {"product_id": "hub_products", "order_id": "hub_orders"})

# Satellites ----------------------------------------------------------------
_satellite("sat_customers_geolocation", "hub_customers", "customer_id",
           {"zip_code": (_INT,)}, history=True)
_satellite("sat_customers_info", "hub_customers", "customer_id",
           {"customer_unique_id": (_S100,), "customer_name": (_S100,), "date_of_birth": DateType()})
_satellite("sat_customers_contacts", "hub_customers", "customer_id",
           {"email": (_S50,), "phone_number": _S50})
_satellite("sat_reviews", "hub_reviews", "review_id",
           {"review_score": (_INT,), "comment_title": _S100, "comment_message": _S300,
            "creation_date": _TIME, "answer_timestamp": _TIME, "is_commented": (BooleanType(),)})
_satellite("sat_category", "hub_categories", "category_id",
           {"category_name": (_S100,), "category_name_origin": (_S100,)})
_satellite("sat_products_names", "hub_products", "product_id", {"product_name": (_S100,)})
_satellite("sat_products_dimensions", "hub_products", "product_id",
           {"weight_g": _NUM, "length_cm": _NUM, "height_cm": _NUM, "width_cm": _NUM})
_satellite("sat_sellers_info", "hub_sellers", "seller_id",
           {"email": _S100, "phone_number": _S100})
_satellite("sat_order_statuses", "hub_orders", "order_id",
           {"order_status": (_S100,)}, history=True)
_satellite("sat_order_details", "hub_orders", "order_id",
           {"order_purchase_timestamp": (_TIME,), "order_approved_at": _TIME,
            "order_delivered_carrier_date": _TIME, "order_delivered_customer_date": _TIME,
            "order_estimated_delivery_date": _TIME})
_satellite("sat_coordinates", "hub_geolocations", "geolocation_id",
           {"latitude": (_NUM,), "longitude": (_NUM,)})
_satellite("sat_cities_info", "hub_cities", "city_id", {"city_name": (_S100,), "state": _S100})

TABLES = dict(_TABLES)


def tables_of(layer: str) -> list[Table]:
    return [t for t in TABLES.values() if t.layer == layer]


def _raw(**columns: DataType) -> StructType:
    return StructType([StructField(c, t, True) for c, t in columns.items()])


_STR = StringType()

# Raw CSV files, in the column order of their headers.
RAW_FEEDS = {
    "customers": _raw(
        customer_id=_STR, customer_unique_id=_STR, customer_zip_code_prefix=_INT,
        customer_city=_STR, customer_state=_STR),
    "geolocation": _raw(
        geolocation_zip_code_prefix=_INT, geolocation_lat=_NUM, geolocation_lng=_NUM,
        geolocation_city=_STR, geolocation_state=_STR),
    "orders": _raw(
        order_id=_STR, customer_id=_STR, order_status=_STR, order_purchase_timestamp=_TIME,
        order_approved_at=_TIME, order_delivered_carrier_date=_TIME,
        order_delivered_customer_date=_TIME, order_estimated_delivery_date=_TIME),
    "products": _raw(
        product_id=_STR, product_category_name=_STR, product_name_lenght=_INT,
        product_description_lenght=_INT, product_photos_qty=_INT, product_weight_g=_NUM,
        product_length_cm=_NUM, product_height_cm=_NUM, product_width_cm=_NUM),
    "translation": _raw(product_category_name=_STR, product_category_name_english=_STR),
    "sellers": _raw(
        seller_id=_STR, seller_zip_code_prefix=_INT, seller_city=_STR, seller_state=_STR),
    "order_items": _raw(
        order_id=_STR, order_item_id=LongType(), product_id=_STR, seller_id=_STR,
        shipping_limit_date=_TIME, price=_NUM, freight_value=_NUM),
    "payments": _raw(
        order_id=_STR, payment_sequential=_INT, payment_type=_STR, payment_installments=_INT,
        payment_value=_NUM),
    "reviews": _raw(
        review_id=_STR, order_id=_STR, review_score=_INT, review_comment_title=_STR,
        review_comment_message=_STR, review_creation_date=_TIME, review_answer_timestamp=_TIME),
}
