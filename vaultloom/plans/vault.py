"""Vault jobs as data: how each hub, link and satellite row comes from staging.

A hub id is the hash of the business key, so a row's references are computed
and no hub is joined to look them up. A hub is needed only to prove that it holds
the id, and only for references to another feed: a feed's own hub was loaded from
the same staging rows just before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultloom.functions.keys import INT60, digest_of, float_input, key_of
from vaultloom.operators import history, merge, quality
from vaultloom.operators.dedup import anti_join_null_safe, bounded, not_among
from vaultloom.sources.tables import TABLES

UPSERT, INSERT, HISTORY = "upsert", "insert", "history"
FLOATING = ("latitude", "longitude")


@dataclass(frozen=True)
class Ref:
    """A hub id computed from business columns.

    ``nullable``: a NULL business key hashes to a normal id (the hubs without a
    key column); otherwise such a row is rejected.
    """

    columns: tuple[str, ...]
    nullable: bool = False

    def inputs(self) -> list[str]:
        return [float_input(c) if c in FLOATING else c for c in self.columns]

    def expression(self, key: str = INT60) -> str:
        return key_of(key, *self.inputs())


@dataclass(frozen=True)
class Job:
    table: str
    source: str
    refs: dict[str, Ref]
    values: dict[str, str] = field(default_factory=dict)  # column -> staging column
    mode: str = UPSERT
    distinct: bool = False
    foreign: tuple[str, ...] = ()  # references into another feed's hub
    combined: dict[str, tuple[str, ...]] = field(default_factory=dict)  # id over columns
    where: str | None = None
    smallest: str | None = None  # of several rows per id, the one with the least value


CUSTOMER = Ref(("customer_id",))
ORDER = Ref(("order_id",))
PRODUCT = Ref(("product_id",))
SELLER = Ref(("seller_id",))
REVIEW = Ref(("review_id",))
CATEGORY = Ref(("category_name_eng",), nullable=True)
POINT = Ref(("zip_code", "latitude", "longitude"), nullable=True)
CITY = Ref(("city", "state"), nullable=True)

# ``distinct`` stands only where the staging key does not already make rows unique.
HUB_JOBS = [
    Job("hub_customers", "customers", {"id": CUSTOMER}, {"customer_id": "customer_id"}),
    Job("hub_orders", "orders", {"id": ORDER}, {"order_id": "order_id"}),
    Job("hub_products", "products", {"id": PRODUCT}, {"product_id": "product_id"}),
    Job("hub_categories", "products", {"id": CATEGORY}, mode=INSERT, distinct=True),
    Job("hub_sellers", "sellers", {"id": SELLER}, {"seller_id": "seller_id"}),
    Job("hub_reviews", "reviews", {"id": REVIEW}, {"review_id": "review_id"}),
    Job("hub_geolocations", "geolocation", {"id": POINT}, mode=INSERT),
    Job("hub_cities", "geolocation", {"id": CITY}, mode=INSERT, distinct=True),
]

LINK_JOBS = [
    Job("l_order_customer", "orders", {"order_id": ORDER, "customer_id": CUSTOMER},
        foreign=("customer_id",)),
    Job("l_customer_geolocation", "customers", {"customer_id": CUSTOMER}, {"zip_code": "zip_code"}),
    Job("l_geolocation_city", "geolocation", {"city_id": CITY}, {"zip_code": "zip_code"},
        distinct=True, combined={"id": ("city_id", "zip_code")}),
    Job("l_seller_geolocation", "sellers", {"seller_id": SELLER}, {"zip_code": "zip_code"}),
    Job("l_product_seller", "order_items", {"product_id": PRODUCT, "seller_id": SELLER},
        distinct=True, foreign=("product_id", "seller_id")),
    Job("l_product_category", "products", {"product_id": PRODUCT, "category_id": CATEGORY}),
    Job("l_review_order", "reviews", {"review_id": REVIEW, "order_id": ORDER},
        foreign=("order_id",)),
    Job("l_order_items", "order_items", {"product_id": PRODUCT, "order_id": ORDER},
        {"order_item_num": "order_item_id", "price": "price", "freight_value": "freight_value"},
        foreign=("product_id", "order_id"),
        combined={"order_item_id": ("product_id", "order_id", "order_item_num")}),
]

SATELLITE_JOBS = [
    Job("sat_customers_geolocation", "customers", {"customer_id": CUSTOMER},
        {"zip_code": "zip_code"}, mode=HISTORY),
    Job("sat_customers_info", "customers", {"customer_id": CUSTOMER},
        {"customer_unique_id": "customer_unique_id", "customer_name": "customer_name",
         "date_of_birth": "date_of_birth"}),
    Job("sat_customers_contacts", "customers", {"customer_id": CUSTOMER},
        {"email": "email", "phone_number": "phone_number"}),
    Job("sat_reviews", "reviews", {"review_id": REVIEW},
        {c: c for c in ("review_score", "comment_title", "comment_message", "creation_date",
                        "answer_timestamp", "is_commented")}),
    Job("sat_category", "products", {"category_id": CATEGORY},
        {"category_name": "category_name_eng", "category_name_origin": "category_name"},
        distinct=True, where="category_name_eng IS NOT NULL", smallest="category_name_origin"),
    Job("sat_products_names", "products", {"product_id": PRODUCT}, {"product_name": "product_name"}),
    Job("sat_products_dimensions", "products", {"product_id": PRODUCT},
        {c: c for c in ("weight_g", "length_cm", "height_cm", "width_cm")}),
    Job("sat_sellers_info", "sellers", {"seller_id": SELLER},
        {"email": "email", "phone_number": "phone_number"}),
    Job("sat_order_statuses", "orders", {"order_id": ORDER},
        {"order_status": "order_status"}, mode=HISTORY),
    Job("sat_order_details", "orders", {"order_id": ORDER},
        {c: c for c in ("order_purchase_timestamp", "order_approved_at",
                        "order_delivered_carrier_date", "order_delivered_customer_date",
                        "order_estimated_delivery_date")}),
    Job("sat_coordinates", "geolocation", {"geolocation_id": POINT},
        {"latitude": "latitude", "longitude": "longitude"}),
    Job("sat_cities_info", "geolocation", {"city_id": CITY},
        {"city_name": "city", "state": "state"}, distinct=True),
]

LAYERS = [HUB_JOBS, LINK_JOBS, SATELLITE_JOBS]
JOBS = {job.table: job for layer in LAYERS for job in layer}

Keep = Callable[[DataFrame, str], DataFrame]


def required_inputs(job: Job) -> list[str]:
    """Staging columns whose NULL would break a NOT NULL rule of the table.

    Rows are checked on these rather than on the finished columns: the filter
    reaches the scan, and no hash is computed just to test it.
    """
    required = TABLES[job.table].required
    keys = {c for ref in job.refs.values() if not ref.nullable for c in ref.columns}
    return sorted(keys | {src for column, src in job.values.items() if column in required})


def business_rows(
    job: Job, staged: DataFrame, keep: Keep | None = None, complete: bool = True
) -> DataFrame:
    """Rows of the staging columns that the job reads, each once if the job says so;
    ``complete`` leaves out those that lack a required value.

    Rows are folded before anything is hashed or joined. ``keep`` writes the
    folded rows where checks follow, since the optimizer would push the checks'
    joins below the DISTINCT, onto every row.
    """
    needed = {c for ref in job.refs.values() for c in ref.columns} | set(job.values.values())
    rows = staged.filter(job.where) if job.where else staged
    rows = quality.complete_rows(rows.select(*sorted(needed)), required_inputs(job) if complete else [])
    if job.smallest:
        least = job.values[job.smallest]
        others = sorted(needed - {least})
        return rows.groupBy(*others).agg(F.min(least).alias(least))
    if job.distinct:
        rows = rows.distinct()
        if keep is not None and job.foreign:
            rows = keep(rows, f"{job.table}.rows")
    return rows


def may_forget(job: Job) -> bool:
    """Whether staging can lose a business key of the hub: where it is not staging's key."""
    [ref] = job.refs.values()
    return set(ref.columns) != set(TABLES[job.source].key)


def key_digests(job: Job, rows: DataFrame, key: str = INT60) -> DataFrame:
    """(id, digest) of a hub's business keys; the digest tells keys apart that share an id."""
    [ref] = job.refs.values()
    return rows.selectExpr(f"{ref.expression(key)} AS id", f"{digest_of(*ref.inputs())} AS digest").distinct()


def orphans(
    job: Job, rows: DataFrame, column: str, hubs: Mapping[str, DataFrame], key: str = INT60
) -> DataFrame:
    """Business keys of a reference whose hub lacks the id, each once.

    The distinct comes first: it folds hot values inside the tasks, so the rows
    that refer to one popular parent never meet in a single partition.
    """
    hub = hubs[TABLES[job.table].parents[column]]
    keys = reference_keys(job, rows, column, key)
    return not_among(keys, hub, ["id"]).select(*job.refs[column].columns)


def reference_keys(job: Job, rows: DataFrame, column: str, key: str = INT60) -> DataFrame:
    """(business columns, id) of a reference, each once."""
    ref = job.refs[column]
    return rows.select(*ref.columns).distinct().selectExpr("*", f"{ref.expression(key)} AS id")


def held_ids(keys: DataFrame, hub: DataFrame) -> DataFrame:
    """Ids of the keys that the hub holds. ``keys`` is the written, small side: the planner
    broadcasts it, and the hub's ids are scanned without being moved."""
    return hub.select("id").join(keys.select("id"), "id", "left_semi")


def checked_references(job: Job, strict: bool) -> tuple[str, ...]:
    """References proved against the hub; ``strict`` proves the feed's own too."""
    return tuple(TABLES[job.table].parents) if strict else job.foreign


def missing_references(
    job: Job,
    rows: DataFrame,
    hubs: Mapping[str, DataFrame],
    strict: bool = False,
    keep: Keep | None = None,
    key: str = INT60,
) -> dict[str, DataFrame]:
    """Orphan keys per checked reference of the business rows.

    ``keep`` may write a DataFrame under a name and read it back. Orphan keys
    are usually few; once written their size is known, and the planner
    broadcasts them instead of moving the wide rows.
    """
    found = {c: orphans(job, rows, c, hubs, key) for c in checked_references(job, strict)}
    if keep is None:
        return found
    return {c: keep(df, f"{job.table}.{c}") for c, df in found.items()}


def source_rows(
    job: Job, rows: DataFrame, missing: Mapping[str, DataFrame], load_ts: str, load_src: str,
    key: str = INT60,
) -> DataFrame:
    """The rows the job merges: business rows whose references are in their hubs."""
    for column, orphan_keys in missing.items():
        ref = job.refs[column]
        if ref.nullable:
            rows = anti_join_null_safe(rows, orphan_keys, ref.columns)
        else:
            rows = rows.join(orphan_keys, list(ref.columns), "left_anti")
    return finished_rows(job, rows, load_ts, load_src, key)


def finished_rows(
    job: Job, rows: DataFrame, load_ts: str, load_src: str, key: str = INT60
) -> DataFrame:
    """Business rows as rows of the table, but for the interval of a history."""
    fields = {f.name: f.dataType.simpleString() for f in TABLES[job.table].plain_schema}
    ids = [f"{ref.expression(key)} AS {column}" for column, ref in job.refs.items()]
    values = [f"cast({src} as {fields[c]}) AS {c}" for c, src in job.values.items()]
    rows = rows.selectExpr(*ids, *values)
    made = {c: f"{key_of(key, *columns)} AS {c}" for c, columns in job.combined.items()}
    present = [c for c in fields if c in made or c in rows.columns]
    return rows.selectExpr(
        *[made.get(c, c) for c in present], *merge.audit_columns(load_ts, load_src))


def incomplete(job: Job) -> str:
    """The condition on a staged row under which the job leaves it out for a NULL."""
    return f"({job.where or 'true'}) AND ({quality.any_null(required_inputs(job))})"


def rejected_rows(
    job: Job, staged: DataFrame, missing: Mapping[str, DataFrame], any_incomplete: bool = True
) -> DataFrame | None:
    """What the job leaves out, as (table, reason, row): rows that lack a required
    value, unless it is known that there are none, and rows that refer to a key its hub
    does not hold. None where nothing can be left out."""
    needed = {c for ref in job.refs.values() for c in ref.columns} | set(job.values.values())
    rows = (staged.filter(job.where) if job.where else staged).select(*sorted(needed))
    required = required_inputs(job)
    complete = quality.complete_rows(rows, required)
    found = []
    if required and any_incomplete:
        found.append((quality.null_violations(rows, required), "concat('missing ', null_columns)"))
    for column, orphan_keys in missing.items():
        columns = list(job.refs[column].columns)
        reason = f"'no {TABLES[job.table].parents[column]} row'"
        found.append((complete.join(orphan_keys, columns, "left_semi"), reason))
    if not found:
        return None
    row = f"to_json(struct({', '.join(sorted(needed))}), map('ignoreNullFields', 'false')) AS row"
    return reduce(DataFrame.unionByName, [
        df.selectExpr(f"'{job.table}' AS table_name", f"{reason} AS reason", row)
        for df, reason in found
    ])


def load_table(
    job: Job,
    target: DataFrame | None,
    source: DataFrame,
    load_ts: str,
    close: str = history.CLOSE_OPEN_ONLY,
    first_seen: bool = False,
    keep: Keep | None = None,
) -> DataFrame:
    """The table after the load. ``first_seen`` keeps the audit columns a hub row
    got when its key first came, in place of those of the latest load. ``keep`` may write
    the keys that an upsert's source leaves out: see ``merge_upsert``."""
    table = TABLES[job.table]
    if job.mode == HISTORY:
        loaded = history.close_and_insert(
            target, source, list(job.refs), list(job.values), load_ts, close)
    elif job.mode == INSERT or (first_seen and table.layer == "hub"):
        loaded = merge.merge_insert(target, source, table.key)
    else:
        kept = None
        if keep and target is not None:
            kept = bounded(keep(merge.kept_keys(target, source, table.key), f"{job.table}.kept"))
        loaded = merge.merge_upsert(target, source, table.key, kept=kept)
    return loaded.select(*table.columns)
