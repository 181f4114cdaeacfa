"""The same results in DuckDB SQL, written apart from the Spark plans.

Named steps (``raw_orders_2``, ``prep_orders_2`` …) are CTE bodies; a query gets
the steps that it mentions, directly or not. States after several loads are
stated as "the latest load that holds the key wins" rather than as merges.
"""

from __future__ import annotations

import re

from vaultloom.functions.people import (
    BIRTH_DAYS, FIRST_BIRTH_DATE, FIRST_NAMES, LAST_NAMES, MAIL_DOMAINS, WORDS,
)
from vaultloom.sources.tables import TABLES

LOADS = (1, 2, 3)
SRC = "'raw-feeds'"


def ts(n) -> str:
    return f"TIMESTAMP '2024-01-{n:02d} 01:00:00'"


# Scalar functions ------------------------------------------------------------
def part(c: str) -> str:
    return f"coalesce(length(({c})::varchar) || ':' || ({c})::varchar, 'N')"


def hexkey(*cols: str) -> str:
    return f"md5({' || '.join(part(c) for c in cols)})"


def hk(*cols: str, digits: int = 15) -> str:
    return f"('0x' || substr({hexkey(*cols)}, 1, {digits}))::bigint"


def floating(c: str) -> str:
    whole = f"floor(abs({c}))"
    return (f"((CASE WHEN {c} < 0 THEN '-' ELSE '' END) || {whole}::bigint || '+' || "
            f"((abs({c}) - {whole}) * 4611686018427387904::double)::bigint)")


def title(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({c}), "
        r"'[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+'), lambda w: upper(w[1]) || w[2:]), '')"
    )


def cap(c: str) -> str:
    return f"upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


def draw(key: str, slot: int, n: int) -> str:
    return f"(('0x' || substr({hexkey(key)}, {1 + 7 * slot}, 7))::bigint % {n})"


def pick(values, key: str, slot: int) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{draw(key, slot, len(values))} + 1]"


def name_of(key):
    return f"{pick(FIRST_NAMES, key, 0)} || ' ' || {pick(LAST_NAMES, key, 1)}"


def email_of(key):
    return (f"lower({pick(FIRST_NAMES, key, 0)}) || '.' || lower({pick(LAST_NAMES, key, 1)}) || "
            f"{draw(key, 2, 100000)} || '@' || {pick(MAIL_DOMAINS, key, 3)}")


def phone_of(key):
    four = [f"lpad({draw(key, s, 10000)}::varchar, 4, '0')" for s in (2, 3)]
    return f"'+55 (' || ({draw(key, 1, 89)} + 11) || ') 9' || {four[0]} || '-' || {four[1]}"


def born(key):
    return f"DATE '{FIRST_BIRTH_DATE}' + {draw(key, 3, BIRTH_DAYS)}::int"


def words_of(key):
    return title(" || ' ' || ".join(pick(WORDS, key, s) for s in range(3)))


# Raw feeds -------------------------------------------------------------------
def _copies(c):
    return f"unnest(range(CASE WHEN {c} > 9500 THEN 3 WHEN {c} > 9000 THEN 2 ELSE 1 END))"


def _raw(n: int) -> dict[str, str]:
    later = n - 1
    customer_here = ("NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 5000)" if n == 1
                     else "NOT (c_mktsegment = 'BUILDING' AND c_acctbal > 8000)")
    order_here = ("o_orderdate < TIMESTAMP '2001-01-01'" if n == 1
                  else "NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01')")
    places = "nation JOIN region ON n_regionkey = r_regionkey"
    line_id = hk("l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", floating("l_extendedprice"),
                 floating("l_quantity"), "copy")
    return {
        f"cust_{n}": f"""
            SELECT *, (1000 + c_nationkey * 40 + c_custkey % 40
                       + CASE WHEN c_acctbal < 0 THEN {later} ELSE 0 END)::int AS zip,
                   lower(c_mktsegment) || '-do d''' || lower(n_name) AS city
            FROM customer JOIN {places.replace('nation JOIN', 'nation ON c_nationkey = n_nationkey JOIN')}
            WHERE {customer_here}""",
        f"supp_{n}": f"""
            SELECT *, (1000 + s_nationkey * 40 + s_suppkey % 40
                       + CASE WHEN s_acctbal < 0 THEN {later} ELSE 0 END)::int AS zip,
                   'são ' || lower(n_name) || '-mirim' AS city
            FROM supplier JOIN {places.replace('nation JOIN', 'nation ON s_nationkey = n_nationkey JOIN')}""",
        f"raw_customers_{n}": f"""
            SELECT 'C' || c_custkey AS customer_id, c_name AS customer_unique_id, zip, city, r_name AS state
            FROM (SELECT *, {_copies('c_acctbal')} AS copy FROM cust_{n})""",
        f"raw_sellers_{n}": f"""
            SELECT 'S' || s_suppkey AS seller_id, zip, city, r_name AS state
            FROM (SELECT *, {_copies('s_acctbal')} AS copy FROM supp_{n})""",
        f"raw_geolocation_{n}": f"""
            SELECT zip, (c_custkey % 11520)::double / 64::double - 90::double AS lat,
                   floor(c_acctbal)::double / 64::double AS lng, city, r_name AS state
            FROM (SELECT *, {_copies('c_acctbal')} AS copy FROM cust_{n})
            UNION ALL
            SELECT zip, (s_suppkey % 11520)::double / 64::double - 90::double,
                   floor(s_acctbal)::double / 64::double, city, r_name
            FROM (SELECT *, {_copies('s_acctbal')} AS copy FROM supp_{n})""",
        f"raw_orders_{n}": f"""
            SELECT 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id,
                   (['processing', 'shipped', 'DELIVERED'])[
                     (CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END
                      + CASE WHEN o_totalprice > 250000 THEN {later} ELSE 0 END) % 3 + 1] AS status,
                   o_orderdate AS purchased, o_orderdate + INTERVAL 1 DAY AS approved,
                   first_ship, last_ship, o_orderdate + INTERVAL 30 DAY AS estimated
            FROM (SELECT *, unnest(range(CASE WHEN o_totalprice > 490000 THEN 2 ELSE 1 END)) AS copy
                  FROM orders WHERE {order_here})
            LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                       FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
        f"raw_products_{n}": f"""
            SELECT 'P' || p_partkey AS product_id,
                   CASE WHEN p_size <> 13 THEN lower(p_type) || '_' || split_part(p_name, ' ', 2) END AS category,
                   (p_size * 100 + CASE WHEN p_retailprice > 990 THEN {later} ELSE 0 END)::double AS weight_g,
                   p_size::double + 0.5::double AS length_cm, p_size::double / 2::double AS height_cm,
                   p_retailprice AS width_cm
            FROM (SELECT *, unnest(range(CASE p_size WHEN 49 THEN 3 WHEN 50 THEN 2 ELSE 1 END)) AS copy
                  FROM part WHERE {"NOT (p_type = 'LARGE' AND p_size >= 40)" if n == 1 else "true"})""",
        f"raw_translation_{n}": """
            SELECT DISTINCT lower(p_type) || '_' || split_part(p_name, ' ', 2) AS category,
                   split_part(p_name, ' ', 2) || '_' ||
                   CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'budget' ELSE lower(p_type) END AS english
            FROM part WHERE NOT (p_type = 'MEDIUM' AND split_part(p_name, ' ', 2) = 'rod')""",
        f"raw_order_items_{n}": f"""
            SELECT 'O' || l_orderkey AS order_id, {line_id} AS order_item_id,
                   'P' || l_partkey AS product_id, 'S' || l_suppkey AS seller_id,
                   l_shipdate AS shipping_limit_date, l_extendedprice AS price,
                   l_quantity + CASE WHEN l_linenumber = 7 THEN {later} ELSE 0 END AS freight_value
            FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
                                                     l_extendedprice, l_quantity) AS copy FROM lineitem
                  WHERE {"l_shipdate < TIMESTAMP '2001-01-01'" if n == 1 else "true"})""",
        f"raw_payments_{n}": f"""
            SELECT 'O' || o_orderkey AS order_id, seq::int AS payment_sequential,
                   replace(lower(substr(o_orderpriority, 3)), ' ', '_') AS kind,
                   (o_custkey % 12 + 1)::int AS payment_installments,
                   o_totalprice / (CASE WHEN o_totalprice > 250000 THEN 2 ELSE 1 END)::double AS payment_value
            FROM (SELECT *, unnest(range(1, CASE WHEN o_totalprice > 250000 THEN 3 ELSE 2 END)) AS seq
                  FROM orders WHERE {order_here})""",
        f"raw_reviews_{n}": f"""
            SELECT md5(text) AS review_id, 'O' || documents.doc_id AS order_id,
                   (coalesce(1 + 4 * quality, 3)
                    + CASE WHEN lang = 'de' AND quality = 0 THEN {later} ELSE 0 END)::int AS review_score,
                   CASE WHEN source <> 'src7' THEN lang || ' ' || source END AS title,
                   CASE WHEN coalesce(toxic, 0) <> 1 THEN text END AS message,
                   TIMESTAMP '2024-01-01' + to_seconds(documents.doc_id) AS created,
                   TIMESTAMP '2024-01-01' + to_seconds(documents.doc_id) + INTERVAL 36 HOUR AS answered
            FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id
            WHERE {"lang <> 'fr'" if n == 1 else "true"}""",
    }


# Cleaning --------------------------------------------------------------------
def _once_only(source: str, keys: str) -> str:
    return f"(SELECT * FROM {source} QUALIFY count(*) OVER (PARTITION BY {keys}) = 1)"


def _prep(n: int) -> dict[str, str]:
    return {
        f"prep_customers_{n}": f"""
            SELECT customer_id, customer_unique_id, {name_of('customer_id')} AS customer_name,
                   {email_of('customer_id')} AS email, {phone_of('customer_id')} AS phone_number,
                   {born('customer_id')} AS date_of_birth, zip AS zip_code, {title('city')} AS city, state
            FROM {_once_only(f'raw_customers_{n}', 'customer_id')}""",
        f"prep_geolocation_{n}": f"""
            SELECT zip AS zip_code, lat AS latitude, lng AS longitude, {title('city')} AS city, state
            FROM {_once_only(f'raw_geolocation_{n}', 'zip, lat, lng')}""",
        f"prep_orders_{n}": f"""
            SELECT order_id, customer_id, {cap('status')} AS order_status,
                   purchased AS order_purchase_timestamp, approved AS order_approved_at,
                   first_ship AS order_delivered_carrier_date, last_ship AS order_delivered_customer_date,
                   estimated AS order_estimated_delivery_date
            FROM {_once_only(f'raw_orders_{n}', 'order_id')}""",
        f"prep_products_{n}": f"""
            SELECT product_id, {cap("replace(p.category, '_', ' ')")} AS category_name,
                   {cap("replace(english, '_', ' ')")} AS category_name_eng,
                   {words_of('product_id')} AS product_name, weight_g, length_cm, height_cm, width_cm
            FROM {_once_only(f'raw_products_{n}', 'product_id')} p
            LEFT JOIN raw_translation_{n} t ON p.category = t.category""",
        f"prep_sellers_{n}": f"""
            SELECT seller_id, zip AS zip_code, {title('city')} AS city, state,
                   {email_of('seller_id')} AS email, {phone_of('seller_id')} AS phone_number
            FROM {_once_only(f'raw_sellers_{n}', 'seller_id')}""",
        f"prep_order_items_{n}": f"SELECT * FROM raw_order_items_{n}",
        f"prep_payments_{n}": f"""
            SELECT order_id, payment_sequential, {title("replace(kind, '_', ' ')")} AS payment_type,
                   payment_installments, payment_value FROM raw_payments_{n}""",
        f"prep_reviews_{n}": f"""
            SELECT review_id, order_id, review_score, title AS comment_title, message AS comment_message,
                   created AS creation_date, answered AS answer_timestamp, message IS NOT NULL AS is_commented
            FROM {_once_only(f'raw_reviews_{n}', 'review_id')}""",
    }


# Staging: the latest drop that holds a key gives its row ----------------------
STAGING_KEYS = {
    "products": "product_id", "customers": "customer_id",
    "geolocation": "zip_code, latitude, longitude", "sellers": "seller_id", "reviews": "review_id",
    "payments": "order_id, payment_sequential", "order_items": "order_id, order_item_id",
    "orders": "order_id",
}


def _latest(sources: list[tuple[int, str]], keys: str, newest: bool = True) -> str:
    union = " UNION ALL ".join(f"SELECT *, {n} AS load_no FROM {s}" for n, s in sources)
    order = "DESC" if newest else "ASC"
    return (f"SELECT * EXCLUDE (load_no) FROM ({union}) "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY load_no {order}) = 1")


def _staged(n: int) -> dict[str, str]:
    return {
        f"stg_{t}_{n}": _latest([(m, f"prep_{t}_{m}") for m in range(1, n + 1)], keys)
        for t, keys in STAGING_KEYS.items()
    }


# Vault: what load n contributes, then the latest contribution per key ---------
def _sources(n: int, staged: str = "stg", made: str = "src", checked: bool = True, hk=hk) -> dict[str, str]:
    """``checked``: rows whose references are staged. ``hk`` makes the keys."""
    audit = f"{ts(n)} AS load_dttm, {SRC} AS load_src"
    s = {t: f"{staged}_{t}_{n}" for t in STAGING_KEYS}
    cust, order, prod, sell, rev = (
        hk(c) for c in ("customer_id", "order_id", "product_id", "seller_id", "review_id"))
    cat, city = hk("category_name_eng"), hk("city", "state")
    point = hk("zip_code", floating("latitude"), floating("longitude"))
    in_orders = f"order_id IN (SELECT order_id FROM {s['orders']})"
    in_products = f"product_id IN (SELECT product_id FROM {s['products']})"
    in_sellers = f"seller_id IN (SELECT seller_id FROM {s['sellers']})"
    in_customers = f"customer_id IN (SELECT customer_id FROM {s['customers']})"
    once = "DISTINCT"
    if not checked:  # rows as the jobs make them; these rely on staging to make them unique
        in_orders = in_products = in_sellers = in_customers = "true"
        once = ""
    rows = {
        "hub_customers": f"{cust} AS id, customer_id, {audit} FROM {s['customers']}",
        "hub_orders": f"{order} AS id, order_id, {audit} FROM {s['orders']}",
        "hub_products": f"{prod} AS id, product_id, {audit} FROM {s['products']}",
        "hub_categories": f"DISTINCT {cat} AS id, {audit} FROM {s['products']}",
        "hub_sellers": f"{sell} AS id, seller_id, {audit} FROM {s['sellers']}",
        "hub_reviews": f"{rev} AS id, review_id, {audit} FROM {s['reviews']}",
        "hub_geolocations": f"{point} AS id, {audit} FROM {s['geolocation']}",
        "hub_cities": f"DISTINCT {city} AS id, {audit} FROM {s['geolocation']}",
        "l_order_customer": f"{order} AS order_id, {cust} AS customer_id, {audit} "
                            f"FROM {s['orders']} WHERE {in_customers}",
        "l_customer_geolocation": f"{cust} AS customer_id, zip_code, {audit} FROM {s['customers']}",
        "l_geolocation_city": f"DISTINCT {hk(city, 'zip_code')} AS id, {city} AS city_id, zip_code, "
                              f"{audit} FROM {s['geolocation']}",
        "l_seller_geolocation": f"{sell} AS seller_id, zip_code, {audit} FROM {s['sellers']}",
        "l_product_seller": f"DISTINCT {prod} AS product_id, {sell} AS seller_id, {audit} "
                            f"FROM {s['order_items']} WHERE {in_products} AND {in_sellers}",
        "l_product_category": f"{once} {prod} AS product_id, {cat} AS category_id, {audit} "
                              f"FROM {s['products']}",
        "l_review_order": f"{rev} AS review_id, {order} AS order_id, {audit} "
                          f"FROM {s['reviews']} WHERE {in_orders}",
        "l_order_items": f"{hk(prod, order, 'order_item_id')} AS order_item_id, {prod} AS product_id, "
                         f"{order} AS order_id, order_item_id AS order_item_num, "
                         "price::decimal(10,2) AS price, freight_value::decimal(10,2) AS freight_value, "
                         f"{audit} FROM {s['order_items']} WHERE {in_products} AND {in_orders}",
        "sat_customers_geolocation": f"{cust} AS customer_id, zip_code, {audit} FROM {s['customers']}",
        "sat_customers_info": f"{cust} AS customer_id, customer_unique_id, customer_name, "
                              f"date_of_birth, {audit} FROM {s['customers']}",
        "sat_customers_contacts": f"{cust} AS customer_id, email, phone_number, {audit} FROM {s['customers']}",
        "sat_reviews": f"{rev} AS review_id, review_score, comment_title, comment_message, "
                       f"creation_date, answer_timestamp, is_commented, {audit} FROM {s['reviews']}",
        "sat_category": f"{cat} AS category_id, category_name_eng AS category_name, "
                        f"min(category_name) AS category_name_origin, {audit} FROM {s['products']} "
                        "WHERE category_name_eng IS NOT NULL GROUP BY category_name_eng",
        "sat_products_names": f"{prod} AS product_id, product_name, {audit} FROM {s['products']}",
        "sat_products_dimensions": f"{prod} AS product_id, weight_g, length_cm, height_cm, width_cm, "
                                   f"{audit} FROM {s['products']}",
        "sat_sellers_info": f"{sell} AS seller_id, email, phone_number, {audit} FROM {s['sellers']}",
        "sat_order_statuses": f"{order} AS order_id, order_status, {audit} FROM {s['orders']}",
        "sat_order_details": f"{order} AS order_id, order_purchase_timestamp, order_approved_at, "
                             "order_delivered_carrier_date, order_delivered_customer_date, "
                             f"order_estimated_delivery_date, {audit} FROM {s['orders']}",
        "sat_coordinates": f"{point} AS geolocation_id, latitude, longitude, {audit} FROM {s['geolocation']}",
        "sat_cities_info": f"DISTINCT {city} AS city_id, city AS city_name, state, {audit} "
                           f"FROM {s['geolocation']}",
    }
    return {f"{made}_{t}_{n}": f"SELECT {body}" for t, body in rows.items()}


HISTORIES = {"sat_customers_geolocation": ("customer_id", "zip_code"),
             "sat_order_statuses": ("order_id", "order_status")}
INSERT_ONLY = ("hub_categories", "hub_geolocations", "hub_cities")
VAULT_KEYS = {
    **{h: "id" for h in ("hub_customers", "hub_orders", "hub_products", "hub_categories",
                         "hub_sellers", "hub_reviews", "hub_geolocations", "hub_cities")},
    "l_order_customer": "order_id, customer_id", "l_customer_geolocation": "customer_id",
    "l_geolocation_city": "id", "l_seller_geolocation": "seller_id",
    "l_product_seller": "product_id, seller_id", "l_product_category": "product_id, category_id",
    "l_review_order": "review_id, order_id", "l_order_items": "order_item_id",
    "sat_customers_info": "customer_id", "sat_customers_contacts": "customer_id",
    "sat_reviews": "review_id", "sat_category": "category_id", "sat_products_names": "product_id",
    "sat_products_dimensions": "product_id", "sat_sellers_info": "seller_id",
    "sat_order_details": "order_id", "sat_coordinates": "geolocation_id", "sat_cities_info": "city_id",
}


def _states(n: int, made: str = "src", state: str = "") -> dict[str, str]:
    steps = {
        f"{state}{t}_{n}": _latest([(m, f"{made}_{t}_{m}") for m in range(1, n + 1)], keys,
                                   newest=t not in INSERT_ONLY)
        for t, keys in VAULT_KEYS.items()
    }
    for name, (key, value) in HISTORIES.items():
        t = state + name
        seen = " UNION ALL ".join(f"SELECT *, {m} AS m FROM {made}_{name}_{m}" for m in range(1, n + 1))
        steps[f"seen_{t}_{n}"] = seen
        # A row opens where the value differs from the one before, and closes
        # where the next row opens.
        steps[f"opened_{t}_{n}"] = f"""
            SELECT *, lead(load_dttm) OVER (PARTITION BY {key} ORDER BY m) AS next_dttm
            FROM (SELECT *, lag({value}) OVER (PARTITION BY {key} ORDER BY m) AS was
                  FROM seen_{t}_{n}) WHERE was IS NULL OR was <> {value}"""
        steps[f"{t}_{n}"] = f"""
            SELECT {key}, {value}, load_dttm AS valid_from, next_dttm AS valid_to, load_dttm, load_src
            FROM opened_{t}_{n}"""
        # Compatible mode: a closed row carries the last later load that differs from it.
        steps[f"{t}_moving_{n}"] = f"""
            SELECT o.{key}, o.{value}, o.load_dttm AS valid_from,
                   CASE WHEN o.next_dttm IS NOT NULL THEN max(s.load_dttm) END AS valid_to,
                   o.load_dttm, o.load_src
            FROM opened_{t}_{n} o LEFT JOIN seen_{t}_{n} s
              ON s.{key} = o.{key} AND s.m > o.m AND s.{value} <> o.{value}
            GROUP BY o.{key}, o.{value}, o.m, o.load_dttm, o.next_dttm, o.load_src"""
    return steps


def _steps() -> dict[str, str]:
    steps: dict[str, str] = {}
    for n in LOADS:
        for make in (_raw, _prep, _staged, _sources, _states):
            steps.update(make(n))
    for n in LOADS:
        steps.update(_sources(n, made="widesrc", hk=hexkey))
    steps.update(_states(3, made="widesrc", state="wide_"))
    steps.update(_changed_states())
    for n in (1, 2):
        steps[f"untidy_items_{n}"] = f"""
            SELECT CASE WHEN freight_value <> 13 THEN order_id END AS order_id, order_item_id, product_id, seller_id,
                   CASE WHEN freight_value <> 11 THEN price END AS price, freight_value = 7 AS bad
            FROM raw_order_items_{n}"""
        steps[f"tidy_items_{n}"] = f"SELECT * FROM untidy_items_{n} WHERE NOT bad AND order_id IS NOT NULL"
        steps[f"stg_tidy_items_{n}"] = _latest(
            [(m, f"tidy_items_{m}") for m in range(1, n + 1)], STAGING_KEYS["order_items"])
    # both drops of each feed, as vault rows of which none is left out
    steps.update({f"both_{t}_2": f"SELECT * FROM prep_{t}_1 UNION ALL SELECT * FROM prep_{t}_2" for t in STAGING_KEYS})
    steps["both_order_items_2"] = """
        SELECT * REPLACE (CASE WHEN freight_value <> 13 THEN order_id END AS order_id,
                          CASE WHEN freight_value <> 11 THEN price END AS price) FROM prep_order_items_1
        UNION ALL SELECT * FROM prep_order_items_2"""
    steps.update(_sources(2, "both", "any", checked=False))
    return steps


_NAME = re.compile(r"[a-z_]+_\d\b")


def _with_steps(body: str, steps: dict[str, str]) -> str:
    """Put the mentioned steps before the query, each after those it needs."""
    ordered: list[str] = []

    def need(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in steps and name not in ordered:
                need(steps[name])
                if name not in ordered:
                    ordered.append(name)

    need(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({steps[name]})" for name in ordered) + "\n" + body


def _items_cells() -> str:
    return """
        SELECT 'O' || l_orderkey AS order_id, l_linenumber AS order_item_id,
               'P' || l_partkey AS product_id, 'S' || l_suppkey AS seller_id,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 'not yet'
                    ELSE l_shipdate::varchar END AS shipping_limit_date,
               CASE WHEN l_discount = 0.1::double THEN 'zz' ELSE l_extendedprice::varchar END AS price,
               CASE WHEN l_tax > 0 THEN l_quantity END AS freight_value, l_tax = 0.08::double AS longer
        FROM lineitem"""


def _two_modes(n: int) -> str:
    t = "sat_order_statuses"
    return (f"SELECT *, 'open_only' AS close_mode FROM {t}_{n} UNION ALL "
            f"SELECT *, 'all_differing' FROM {t}_moving_{n}")


def _checksums(state: str = "") -> str:
    """Rows of each table after three loads, and the sum of a 32-bit hash of each row."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"sum({hk(*t.columns, digits=8)})::varchar AS checksum "
        f"FROM {'stg_' if name in STAGING_KEYS else state}{name}_3"
        for name, t in TABLES.items())


RANGES = 64


def _values(name: str) -> list[str]:
    return [c for c in TABLES[name].columns if c not in ("load_dttm", "load_src")]


def _changed_states() -> dict[str, str]:
    """States after three loads in which a row's audit columns are of the load that last changed it."""
    steps = {}
    for t, keys in VAULT_KEYS.items():
        if t in INSERT_ONLY:
            steps[f"changed_{t}_3"] = f"SELECT * FROM {t}_3"
            continue
        seen = " UNION ALL ".join(f"SELECT *, {m} AS m FROM src_{t}_{m}" for m in LOADS)
        row = f"row({', '.join(_values(t))})"
        steps[f"changed_{t}_3"] = f"""
            SELECT * EXCLUDE (m, same) FROM (
              SELECT *, coalesce({row} IS NOT DISTINCT FROM lag({row}) OVER (PARTITION BY {keys} ORDER BY m), false)
                        AND m > min(m) OVER (PARTITION BY {keys}) AS same FROM ({seen}))
            WHERE NOT same QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY m DESC) = 1"""
    for t in HISTORIES:
        steps[f"changed_{t}_3"] = f"SELECT * FROM {t}_3"
    return steps


def _ranges_rewritten() -> str:
    """Ranges with a row that is new or other than before; load 3 repeats the second drop."""
    found = []
    for name, t in TABLES.items():
        if name in INSERT_ONLY or name in HISTORIES:
            continue
        staged = name in STAGING_KEYS
        inputs = [floating(c) if t.schema[c].dataType.typeName() == "double" else c for c in t.key]
        columns = ", ".join(_values(name))
        for n in (1, 2):
            now = f"SELECT {columns} FROM {f'stg_{name}_{n}' if staged else f'src_{name}_{n}'}"
            if n > 1:
                now += f" EXCEPT SELECT {columns} FROM {'stg_' if staged else ''}{name}_{n - 1}"
            found.append(f"SELECT {n} AS load_no, '{name}' AS table_name, "
                         f"(SELECT count(DISTINCT {hk(*inputs, digits=4)} % {RANGES}) FROM ({now}))::int AS ranges_rewritten")
        found.append(f"SELECT 3, '{name}', 0")
    return " UNION ALL ".join(found)


def _load_rejects(n: int) -> str:
    """Cells and NULL keys of the drop itself, the rest of what staging holds after it."""
    def left_out(table, reason, source, where, *ids):
        cells = [c if c in ids else f"NULL::varchar AS {c}"
                 for c in ("order_id", "product_id", "seller_id", "customer_id", "review_id")]
        return (f"SELECT {n} AS load_no, '{table}' AS table_name, '{reason}' AS reason, {', '.join(cells)} "
                f"FROM {source} WHERE {where}")

    def unknown(parent):
        return f"{parent}_id NOT IN (SELECT {parent}_id FROM stg_{parent}s_{n})"

    items, staged = f"untidy_items_{n}", f"stg_tidy_items_{n}"
    pair, line = ("product_id", "seller_id"), ("order_id", "product_id")
    return " UNION ALL ".join([
        left_out("order_items", "bad cells price", items, "bad", "order_id", *pair),
        left_out("order_items", "missing order_id", items, "NOT bad AND order_id IS NULL", *pair),
        *[left_out("l_product_seller", f"no hub_{p}s row", staged, unknown(p), *pair)
          for p in ("product", "seller")],
        left_out("l_order_items", "missing price", staged, "price IS NULL", *line),
        *[left_out("l_order_items", f"no hub_{p}s row", staged, f"price IS NOT NULL AND {unknown(p)}", *line)
          for p in ("product", "order")],
        left_out("l_order_customer", "no hub_customers row", f"stg_orders_{n}", unknown("customer"),
                 "order_id", "customer_id"),
        left_out("l_review_order", "no hub_orders row", f"stg_reviews_{n}", unknown("order"),
                 "order_id", "review_id"),
    ])


HASHED_NULLS = ("hub_categories.id", "hub_geolocations.id", "hub_cities.id", "l_geolocation_city.city_id",
                "l_product_category.category_id", "sat_category.category_id", "sat_coordinates.geolocation_id",
                "sat_cities_info.city_id")
MADE_IDS = ("l_geolocation_city.id", "l_order_items.order_item_id")


def _declared_rules() -> str:
    """A NULL business key shows as the hash of NULL, but where that is a normal id."""
    found, of_null = [], hk("NULL::varchar")
    for name, t in TABLES.items():
        staged = name in STAGING_KEYS
        source = f"both_{name}_2" if staged else f"any_{name}_2"
        made = () if staged else ("load_dttm", "load_src", "valid_from")
        ids = {f.name for f in t.schema if f.dataType.typeName() == "long" and f.name.endswith("id")}

        def rule(kind, column, violations, name=name):
            found.append(f"SELECT '{name}' AS table_name, '{kind}' AS rule, '{column}' AS column_name, ({violations}) AS violations")

        for c in t.required:
            if c in made or f"{name}.{c}" in MADE_IDS:
                continue
            broken = f"{c} IS NULL"
            if not staged and c in ids:
                broken = "false" if f"{name}.{c}" in HASHED_NULLS else f"{c} = {of_null}"
            rule("null", c, f"SELECT count(*) FROM {source} WHERE {broken}")
        for c, n in t.max_bytes.items():
            if c not in made:
                rule("length", c, f"SELECT count(*) FROM {source} WHERE strlen({c}) > {n}")
        key = ", ".join(t.key)
        rule("key", ",".join(t.key), f"SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)")
        for c, hub in t.parents.items():
            real = "true" if f"{name}.{c}" in HASHED_NULLS else f"{c} <> {of_null}"
            rule("parent", c, f"SELECT count(DISTINCT {c}) FROM {source} WHERE {real} AND {c} NOT IN (SELECT id FROM {hub}_2)")
    return " UNION ALL ".join(found)


def _hub_keys():
    for t in ("customer", "order", "product", "seller", "review"):
        yield f"hub_{t}s", f"{t}s", [f"{t}_id"], [f"{t}_id"]
    yield "hub_categories", "products", ["category_name_eng"], ["category_name_eng"]
    point = ["zip_code", "latitude", "longitude"]
    yield "hub_geolocations", "geolocation", point, [point[0], floating(point[1]), floating(point[2])]
    yield "hub_cities", "geolocation", ["city", "state"], ["city", "state"]


def all_oracles() -> dict[str, str]:
    steps = _steps()
    reject = "json_object({}) AS row"
    q = {
        "full_load": """
            SELECT h.order_id, s.order_status, s.valid_from AS status_since, l.customer_id,
                   g.zip_code, g.valid_from AS zip_since
            FROM hub_orders_2 h JOIN sat_order_statuses_2 s ON h.id = s.order_id AND s.valid_to IS NULL
            JOIN l_order_customer_2 l ON l.order_id = h.id
            JOIN sat_customers_geolocation_2 g ON g.customer_id = l.customer_id AND g.valid_to IS NULL""",
        "csv_scan": """
            SELECT review_id, order_id, review_score, title AS review_comment_title,
                   message AS review_comment_message, created AS review_creation_date,
                   answered AS review_answer_timestamp FROM raw_reviews_2""",
        "csv_roundtrip": "SELECT *, 1 AS load_no FROM prep_orders_1 UNION ALL SELECT *, 2 FROM prep_orders_2",
        "typed_load_good": f"""
            SELECT order_id, order_item_id::bigint AS order_item_id, product_id, seller_id,
                   shipping_limit_date::timestamp AS shipping_limit_date, price::double AS price, freight_value
            FROM ({_items_cells()}) WHERE shipping_limit_date <> 'not yet' AND price <> 'zz' AND NOT longer""",
        "typed_load_rejects": f"""
            SELECT order_id, order_item_id::varchar AS order_item_id, product_id, seller_id,
                   shipping_limit_date, price, freight_value::varchar AS freight_value,
                   concat_ws(',', CASE WHEN shipping_limit_date = 'not yet' THEN 'shipping_limit_date' END,
                             CASE WHEN price = 'zz' THEN 'price' END, CASE WHEN longer THEN '_record' END) AS bad_columns,
                   CASE WHEN longer THEN concat_ws(',', order_id, order_item_id, product_id, seller_id, shipping_limit_date,
                                                   price, freight_value, 'one more') END AS record
            FROM ({_items_cells()}) WHERE shipping_limit_date = 'not yet' OR price = 'zz' OR longer""",
        "load_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM stg_{t}_2" for t in STAGING_KEYS),
        "append_batch": """
            SELECT *, '2024-01-01 01:00:00' AS load_batch FROM prep_payments_1 UNION ALL
            SELECT *, '2024-01-02 01:00:00' FROM prep_payments_2""",
        "dedup_drop_all": """
            SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
        "union_all": """
            SELECT order_id AS join_key, order_id, order_status FROM src_sat_order_statuses_2 UNION ALL
            SELECT NULL::bigint, b.order_id, b.order_status FROM src_sat_order_statuses_1 a
            JOIN src_sat_order_statuses_2 b ON a.order_id = b.order_id AND a.order_status <> b.order_status""",
        "distinct_rows": "SELECT DISTINCT user_id, event_type FROM events",
        "hash_key_1": f"SELECT doc_id, {hk('text')} AS text_key, {hexkey('text')} AS text_hex FROM documents",
        "hash_key_n": f"""
            SELECT event_id, {hk('user_id', 'ts', floating('value'))} AS event_key,
                   {hk('event_type', 'nullif(user_id, 8)')} AS type_key FROM events""",
        "merge_upsert": """
            SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
                   CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN c_acctbal + 100
                        ELSE c_acctbal END AS c_acctbal FROM customer""",
        "merge_insert_only": """
            SELECT user_id, CASE WHEN bool_or(event_type = 'click' AND value > 50) THEN 'click'
                                 ELSE 'any' END AS first_seen FROM events GROUP BY user_id""",
        "scd2_changed_keys": """
            SELECT b.customer_id, b.zip_code FROM src_sat_customers_geolocation_1 a
            JOIN src_sat_customers_geolocation_2 b ON a.customer_id = b.customer_id
            WHERE a.zip_code <> b.zip_code""",
        "scd2_two_loads": _two_modes(2),
        "scd2_three_loads": _two_modes(3),
        "scd2_late_drop": "SELECT * FROM sat_order_statuses_3",
        "enrich_people": f"""
            SELECT c_custkey, {name_of('c_name')} AS customer_name, {email_of('c_name')} AS email,
                   {phone_of('c_name')} AS phone_number, {born('c_name')} AS date_of_birth FROM customer""",
        "enrich_product_names": f"SELECT p_partkey, {words_of('p_partkey')} AS product_name FROM part",
        "dq_pk_violations": """
            SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2
            HAVING count(*) > 1""",
        "dq_null_violations": """
            SELECT product_id, category_name, category_name_eng,
                   CASE WHEN category_name IS NULL THEN 'category_name,category_name_eng'
                        ELSE 'category_name_eng' END AS null_columns
            FROM stg_products_2 WHERE category_name_eng IS NULL""",
        "dq_fk_orphans": """
            SELECT DISTINCT order_id FROM stg_order_items_2
            WHERE order_id NOT IN (SELECT order_id FROM stg_orders_2)""",
        "dq_too_long": " UNION ALL ".join(
            f"SELECT review_id, '{c}' AS column_name, strlen({c})::int AS bytes, {n} AS max_bytes "
            f"FROM stg_reviews_2 WHERE strlen({c}) > {n}"
            for c, n in (("review_id", 100), ("order_id", 100), ("comment_title", 100),
                         ("comment_message", 300))),
        "dq_hash_collisions": " UNION ALL ".join(f"""
            SELECT '{hub}' AS table_name, {hk(*inputs, digits=2)} AS id, count(*) AS business_keys
            FROM (SELECT DISTINCT {", ".join(columns)} FROM both_{staged}_2) GROUP BY 2 HAVING count(*) > 1"""
            for hub, staged, columns, inputs in _hub_keys()),
        "dq_merge_ambiguity": """
            SELECT zip_code, count(*) AS copies FROM stg_geolocation_2 GROUP BY 1 HAVING count(*) > 1""",
        "vault_rejects": f"""
            SELECT 'l_order_customer' AS table_name, 'no hub_customers row' AS reason,
                   {reject.format("'customer_id', customer_id, 'order_id', order_id")}
            FROM stg_orders_2 WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers_2)
            UNION ALL
            SELECT 'l_review_order', 'no hub_orders row',
                   {reject.format("'order_id', order_id, 'review_id', review_id")}
            FROM stg_reviews_2 WHERE order_id NOT IN (SELECT order_id FROM stg_orders_2)
            """ + "".join(f"""
            UNION ALL
            SELECT '{link}', 'no hub_{parent}s row', {reject.format(cells)}
            FROM stg_order_items_2 WHERE {parent}_id NOT IN (SELECT {parent}_id FROM stg_{parent}s_2)"""
            for link, cells, parents in (
                ("l_product_seller", "'product_id', product_id, 'seller_id', seller_id",
                 ("product", "seller")),
                ("l_order_items", "'freight_value', freight_value, 'order_id', order_id, "
                 "'order_item_id', order_item_id, 'price', price, 'product_id', product_id",
                 ("product", "order")))
            for parent in parents),
        "load_tables": _checksums(),
        "load_tables_bucketed": _checksums(),
        "load_tables_wide": _checksums("wide_"),
        "load_tables_changed": _checksums("changed_"),
        "load_ranges": _ranges_rewritten(),
        "load_rejects": " UNION ALL ".join(_load_rejects(n) for n in (1, 2)),
        "dq_declared_rules": _declared_rules(),
    }
    for t in STAGING_KEYS:
        q["prep_geolocations" if t == "geolocation" else f"prep_{t}"] = (
            f"SELECT *, 1 AS load_no FROM prep_{t}_1 UNION ALL SELECT *, 2 FROM prep_{t}_2")
        q[f"stg_{t}"] = f"SELECT * FROM stg_{t}_2"
    q.update({t: f"SELECT * FROM {t}_2" for t in VAULT_KEYS})
    q.update({t: f"SELECT * FROM {t}_3" for t in HISTORIES})
    return {name: _with_steps(body.strip(), steps) for name, body in q.items()}
