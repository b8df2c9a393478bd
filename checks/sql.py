"""DuckDB twins of the fixture and of the shared stages, as WITH clauses."""

from __future__ import annotations

from haulmetrics.schema import (LABEL_DEFAULTS, ORDER_COLUMNS, SPLIT_FEATURES, SPLIT_IDS,
                                SPLIT_TARGETS, WAREHOUSE_CAPACITY)


def r(expression: str, digits: int = 0) -> str:
    scale = f"1e{digits}"
    return f"(round_even(({expression})::DOUBLE * {scale}, 0) / {scale} + 0.0)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1}))"
             f" * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)")
    return f"2 * 6371.0::DOUBLE * asin(sqrt({chord}))"


def days_between(start: str, end: str) -> str:
    return f"floor((epoch_us({end}) - epoch_us({start}))::DOUBLE / 86400000000e0)::BIGINT"


def columns(names, table: str = "") -> str:
    return ", ".join(f"{table}.{n}" if table else n for n in names)


STAR = """
star AS (
  SELECT l.*, o.*, c.*, p.*, s.*, cn.n_nationkey AS c_nk, cn.n_name AS c_nation,
         cr.r_name AS c_region, sn.n_nationkey AS s_nk, sr.r_name AS s_region,
         l_orderkey || lpad(l_linenumber::VARCHAR, 2, '0') || lpad(l_partkey::VARCHAR, 12, '0')
           || lpad(l_suppkey::VARCHAR, 12, '0') || strftime(l_shipdate, '%Y%m%d') AS line_key,
         ((date_diff('day', o_orderdate::DATE, l_shipdate::DATE) % 15) + 15) % 15 AS taken,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 0 WHEN '2' THEN 2 WHEN '3' THEN 5
              WHEN '4' THEN 8 ELSE 12 END AS promised
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  JOIN customer c ON o_custkey = c_custkey JOIN part p ON l_partkey = p_partkey
  JOIN supplier s ON l_suppkey = s_suppkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
)"""

_DIST = r(haversine("(-60e0 + 5e0 * s_nk)", "(-150e0 + 12e0 * s_nk)",
                    "(-60e0 + 5e0 * c_nk)", "(-150e0 + 12e0 * c_nk)"), 2)

RAW = STAR + f""",
measured AS (
  SELECT *, CASE WHEN l_orderkey % 151 <> 0 THEN {_DIST} END AS dist,
         CASE WHEN p_partkey % 97 <> 0 THEN p_size * 0.5e0 END AS weight,
         CASE WHEN l_partkey % 50 <> 0 THEN taken::DOUBLE END AS actual
  FROM star),
shipments_one AS (
  SELECT 'ORD-' || line_key AS order_id,
    CASE WHEN l_orderkey % 333 = 0 THEN '2025-13-45'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    'CUST-' || o_custkey AS customer_id, c_mktsegment AS customer_segment,
    'PROD-' || l_partkey AS product_id,
    CASE WHEN l_partkey % 211 = 0 THEN NULL
         WHEN l_partkey % 25 = 0 THEN '  ' || lower(p_type) || chr(9)
         ELSE p_type END AS product_category,
    l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price,
    l_discount AS discount_rate, weight AS weight_kg,
    CASE WHEN l_suppkey % 12 + 1 <= 8 THEN 'WH-00' || (l_suppkey % 12 + 1)
         ELSE 'SELLER-' || l_suppkey END AS origin_warehouse_id,
    s_region AS origin_region, 'City ' || c_nk AS destination_city,
    c_nation AS destination_country, c_region AS destination_region,
    CASE WHEN c_custkey % 101 = 0 THEN NULL WHEN c_custkey % 67 = 0 THEN 95e0
         ELSE -60e0 + 5e0 * c_nk END AS destination_latitude,
    -150e0 + 12e0 * c_nk AS destination_longitude, dist AS distance_km,
    CASE WHEN l_linenumber % 5 = 0 THEN ' ' || s_name || ' ' ELSE s_name END AS carrier,
    CASE WHEN l_suppkey % 2 = 1 THEN NULL
         ELSE ['Same Day', 'First Class', 'Second Class', 'Standard Class'][l_linenumber % 4 + 1]
    END AS shipping_mode,
    promised::DOUBLE AS promised_delivery_days, actual AS actual_delivery_days,
    CASE WHEN l_orderkey % 100 <> 0 THEN 2.5e0 + 0.015e0 * dist + 0.9e0 * weight END
      AS shipping_cost,
    CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END || ' '
      AS order_status,
    CASE WHEN actual IS NULL THEN 'Not delivered' WHEN actual > promised THEN 'Late delivery'
         ELSE 'None' END AS delay_reason,
    CASE WHEN l_suppkey % 2 = 1 THEN 'olist' ELSE 'dataco' END AS source_system,
    l_orderkey
  FROM measured),
shipments_raw AS (
  SELECT * EXCLUDE (l_orderkey) FROM shipments_one
  UNION ALL SELECT * EXCLUDE (l_orderkey) FROM shipments_one WHERE l_orderkey % 200 = 0)"""

BLANKS = "' ' || chr(9) || chr(10) || chr(13)"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def title_word(x: str) -> str:
    return f"upper(left({x}, 1)) || lower(substr({x}, 2))"


MODE_CASE = ("CASE WHEN promised_delivery_days <= 0 THEN 'Same Day' WHEN promised_delivery_days <= 2"
             " THEN 'First Class' WHEN promised_delivery_days <= 5 THEN 'Second Class'"
             " WHEN promised_delivery_days IS NOT NULL THEN 'Standard Class' END")

# Up to and including the coordinate filter; nothing imputed.
LOCATED = RAW + f""",
deduped AS (SELECT DISTINCT * FROM shipments_raw),
dated AS (SELECT * REPLACE (try_strptime(order_date, '%Y-%m-%d') AS order_date) FROM deduped
          WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL),
standard AS (
  SELECT * REPLACE (
    coalesce({title_word(strip('product_category'))}, 'Unknown') AS product_category,
    {strip('carrier')} AS carrier, upper({strip('order_status')}) AS order_status,
    coalesce(shipping_mode, {MODE_CASE}, 'Standard Class') AS shipping_mode)
  FROM dated),
located AS (SELECT * FROM standard WHERE destination_latitude BETWEEN -90 AND 90
            AND destination_longitude BETWEEN -180 AND 180)"""

CLEAN = LOCATED + f""",
filled AS (
  SELECT l.* REPLACE (
    coalesce(l.actual_delivery_days, a.m) AS actual_delivery_days,
    coalesce(l.shipping_cost, b.m) AS shipping_cost,
    coalesce(l.distance_km, c.m) AS distance_km,
    coalesce(l.weight_kg, d.m) AS weight_kg)
  FROM located l
  LEFT JOIN (SELECT carrier, shipping_mode, median(actual_delivery_days) AS m FROM located
             GROUP BY ALL) a ON l.carrier = a.carrier AND l.shipping_mode = a.shipping_mode
  LEFT JOIN (SELECT shipping_mode, median(shipping_cost) AS m FROM located GROUP BY ALL) b
    ON l.shipping_mode = b.shipping_mode
  LEFT JOIN (SELECT destination_region, median(distance_km) AS m FROM located GROUP BY ALL) c
    ON l.destination_region = c.destination_region
  LEFT JOIN (SELECT product_category, median(weight_kg) AS m FROM located GROUP BY ALL) d
    ON l.product_category = d.product_category),
clean AS (
  SELECT * REPLACE (
    trunc(quantity)::BIGINT AS quantity,
    {r('coalesce(actual_delivery_days, (SELECT median(actual_delivery_days) FROM filled))')}::BIGINT
      AS actual_delivery_days,
    trunc(promised_delivery_days)::BIGINT AS promised_delivery_days,
    {r('unit_price', 2)} AS unit_price,
    {r('coalesce(shipping_cost, (SELECT median(shipping_cost) FROM filled))', 2)} AS shipping_cost,
    coalesce(distance_km, (SELECT median(distance_km) FROM filled)) AS distance_km,
    coalesce(weight_kg, (SELECT median(weight_kg) FROM filled)) AS weight_kg)
  FROM filled)"""

DISTANCE_CASE = ("CASE WHEN distance_km < 0 OR distance_km IS NULL THEN NULL"
                 " WHEN distance_km <= 500 THEN 'Local' WHEN distance_km <= 2000 THEN 'Regional'"
                 " WHEN distance_km <= 6000 THEN 'Long-Haul' ELSE 'International' END")
SIZE_CASE = ("CASE WHEN weight_kg * quantity < 0 OR weight_kg * quantity IS NULL THEN NULL"
             " WHEN weight_kg * quantity <= 5 THEN 'Small' WHEN weight_kg * quantity <= 25"
             " THEN 'Medium' WHEN weight_kg * quantity <= 100 THEN 'Large' ELSE 'Bulk' END")
CAPACITY_VALUES = ", ".join(f"('{w}', '{g}', {c})" for w, g, c in WAREHOUSE_CAPACITY)

FEATURED = CLEAN + f""",
capacity AS (SELECT * FROM (VALUES {CAPACITY_VALUES})
             AS t(warehouse_id, region, capacity_units_per_day)),
unit_cost AS (
  SELECT *, actual_delivery_days - promised_delivery_days AS delivery_delay,
    (actual_delivery_days > promised_delivery_days)::INTEGER AS is_delayed,
    {r('shipping_cost / nullif(quantity, 0)', 3)} AS cost_rounded,
    distance_km / nullif(actual_delivery_days, 0) AS speed,
    order_date::DATE AS order_day, date_trunc('month', order_date)::DATE AS order_month,
    {DISTANCE_CASE} AS distance_category, {SIZE_CASE} AS shipment_size_category
  FROM clean),
month_counts AS (SELECT order_month, count(order_id) AS n FROM unit_cost GROUP BY 1),
seasonal AS (
  SELECT u.*, coalesce(cost_rounded, (SELECT median(cost_rounded) FROM unit_cost))
                AS shipping_cost_per_unit,
    {r('m.n / (SELECT avg(n) FROM month_counts)', 4)} AS seasonal_demand_index,
    min(speed) OVER (PARTITION BY destination_region) AS lo,
    max(speed) OVER (PARTITION BY destination_region) AS hi,
    sum(is_delayed) OVER (PARTITION BY u.carrier) / count(*) OVER (PARTITION BY u.carrier)
      AS carrier_late,
    sum(quantity) OVER (PARTITION BY origin_warehouse_id, order_day) AS wh_units,
    sum(quantity) OVER (PARTITION BY product_category, order_day) AS cat_units,
    sum(quantity) OVER (PARTITION BY product_category)
      / count(quantity) OVER (PARTITION BY product_category) AS cat_mean,
    sum(is_delayed) OVER (PARTITION BY u.carrier, product_category)
      / count(*) OVER (PARTITION BY u.carrier, product_category) AS pair_late
  FROM unit_cost u JOIN month_counts m USING (order_month)),
spread AS (SELECT product_category, coalesce(stddev_samp(seasonal_demand_index), 0) AS vol
           FROM seasonal GROUP BY 1),
scaled AS (SELECT product_category, vol, (vol - (SELECT min(vol) FROM spread))
             / ((SELECT max(vol) FROM spread) - (SELECT min(vol) FROM spread) + 1e-9) AS vol_scaled
           FROM spread),
peaks AS (SELECT origin_warehouse_id, max(wh_units) AS peak FROM seasonal GROUP BY 1),
featured AS (
  SELECT {columns(ORDER_COLUMNS, 's')}, s.source_system, delivery_delay, is_delayed,
    shipping_cost_per_unit,
    {r('CASE WHEN hi > lo THEN (speed - lo) / (hi - lo) ELSE 0.5e0 END', 4)}
      AS route_efficiency_score,
    {r('1 - carrier_late', 4)} AS carrier_performance_score, seasonal_demand_index,
    distance_category,
    {r('wh_units / nullif(coalesce(c.capacity_units_per_day, p.peak), 0)', 4)}
      AS warehouse_utilization,
    {r('cat_units / (cat_mean * 30)', 4)} AS inventory_turnover,
    {r('0.65e0 * pair_late + 0.35e0 * vol_scaled', 4)} AS reorder_risk_score,
    shipment_size_category, s.pair_late, x.vol, x.vol_scaled, s.wh_units, s.order_day,
    s.order_month
  FROM seasonal s JOIN scaled x USING (product_category)
  JOIN peaks p ON s.origin_warehouse_id = p.origin_warehouse_id
  LEFT JOIN capacity c ON s.origin_warehouse_id = c.warehouse_id)"""

SPLIT = FEATURED + f""",
marked AS (
  SELECT {columns(SPLIT_IDS + SPLIT_FEATURES + SPLIT_TARGETS)},
    CASE WHEN (('0x' || substr(md5(order_id), 1, 8))::BIGINT % 10000) / 10000e0 < 0.20e0
         THEN 'test' ELSE 'train' END AS split
  FROM featured),
train AS (SELECT * FROM marked WHERE split = 'train'),
test AS (SELECT * FROM marked WHERE split = 'test')"""

TRACK = """
tracking_one AS (
  SELECT event_id, 'ORD-' || (event_id // 5) AS order_id, 'USER-' || user_id AS carrier,
    CASE WHEN event_id % 97 = 0 THEN '2025-13-45' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
      AS event_timestamp,
    ' ' || CASE event_type WHEN 'error' THEN 'delayed' ELSE event_type END || chr(9) AS event_type,
    'LOC-' || (user_id % 25) AS location,
    CASE event_type WHEN 'error' THEN 'Late delivery' ELSE 'None' END AS delay_reason
  FROM events),
tracking_raw AS (
  SELECT * EXCLUDE (event_id) FROM tracking_one
  UNION ALL SELECT * EXCLUDE (event_id) FROM tracking_one WHERE event_id % 50 = 0)"""

EVENTS = TRACK + f""",
tracked AS (
  SELECT DISTINCT * FROM tracking_raw),
clean_events AS (
  SELECT * REPLACE (try_strptime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
                    upper({strip('event_type')}) AS event_type)
  FROM tracked WHERE try_strptime(event_timestamp, '%Y-%m-%d %H:%M:%S') IS NOT NULL)"""

EVENT_COLUMNS = ["order_id", "carrier", "event_timestamp", "event_type", "location",
                 "delay_reason"]
EVENT_TEXT = ("order_id, carrier, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp,"
              " event_type, location, delay_reason")


def text_at(seconds: str) -> str:
    return f"strftime(to_timestamp(epoch(o_orderdate) + {seconds})::TIMESTAMP, '%Y-%m-%d %H:%M:%S')"


def _stamp(seconds: str) -> str:
    return f"make_timestamp((epoch_us(o_orderdate) + ({seconds})::BIGINT * 1000000)::BIGINT)"


MARKET = f"""
m_orders AS (
  SELECT md5('o-' || o_orderkey) AS order_id, md5('c-' || o_orderkey) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END
      AS order_status,
    {_stamp('0')} AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 40 <> 0 THEN {_stamp('(o_orderkey % 5) * 3600')} END
      AS order_approved_at,
    CASE WHEN o_orderkey % 30 <> 0 THEN {_stamp('(1 + o_orderkey % 3) * 86400')} END
      AS order_delivered_carrier_date,
    CASE WHEN o_orderkey % 25 <> 0 THEN {_stamp(
        'CASE WHEN o_orderkey % 77 = 0 THEN -18000 ELSE (o_orderkey % 20) * 86400'
        ' + (o_orderkey % 24) * 3600 END')} END AS order_delivered_customer_date,
    {_stamp('(2 + o_orderkey % 15) * 86400 + 7200')} AS order_estimated_delivery_date
  FROM orders),
m_items AS (
  SELECT md5('o-' || l_orderkey) AS order_id, l_linenumber AS order_item_id,
    md5('p-' || l_partkey) AS product_id, md5('s-' || l_suppkey) AS seller_id,
    printf('%.2f', l_extendedprice)::DOUBLE AS price,
    printf('%.2f', l_quantity * 0.5e0)::DOUBLE AS freight_value
  FROM lineitem),
m_products AS (
  SELECT md5('p-' || p_partkey) AS product_id,
    CASE WHEN p_partkey % 97 <> 0 THEN 'cat_' || lower(p_type) END AS product_category_name,
    CASE WHEN p_partkey % 89 <> 0 THEN p_size * 100e0 END AS product_weight_g
  FROM part),
m_customers AS (
  SELECT md5('c-' || o_orderkey) AS customer_id, md5('u-' || o_custkey) AS customer_unique_id,
    c_nationkey::VARCHAR AS customer_zip_code_prefix, 'porto ' || c_nationkey AS customer_city,
    'S' || (c_nationkey % 5) AS customer_state
  FROM orders JOIN customer ON o_custkey = c_custkey),
m_sellers AS (
  SELECT md5('s-' || s_suppkey) AS seller_id, s_nationkey::VARCHAR AS seller_zip_code_prefix,
    'S' || (s_nationkey % 5) AS seller_state FROM supplier),
m_geolocation AS (
  SELECT c_nationkey::VARCHAR AS geolocation_zip_code_prefix,
    -60e0 + 5e0 * c_nationkey + (c_custkey % 7 - 3) * 0.25e0 AS geolocation_lat,
    -150e0 + 12e0 * c_nationkey + (c_custkey % 5 - 2) * 0.25e0 AS geolocation_lng
  FROM customer WHERE c_nationkey <> 13),
m_translation AS (
  SELECT DISTINCT 'cat_' || lower(p_type) AS product_category_name,
    lower(p_type) || '_goods' AS product_category_name_english FROM part WHERE p_type <> 'PROMO'),
points AS (
  SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat,
    avg(geolocation_lng) AS lng FROM m_geolocation GROUP BY 1)"""

JOINED = MARKET + """,
joined AS (
  SELECT i.*, o.* EXCLUDE (order_id), p.* EXCLUDE (product_id), c.* EXCLUDE (customer_id),
    s.* EXCLUDE (seller_id), t.product_category_name_english,
    a.lat AS geolocation_lat_cust, a.lng AS geolocation_lng_cust,
    b.lat AS geolocation_lat_sell, b.lng AS geolocation_lng_sell
  FROM m_items i JOIN m_orders o USING (order_id)
  LEFT JOIN m_products p ON i.product_id = p.product_id
  LEFT JOIN m_customers c ON o.customer_id = c.customer_id
  LEFT JOIN m_sellers s ON i.seller_id = s.seller_id
  LEFT JOIN m_translation t ON p.product_category_name = t.product_category_name
  LEFT JOIN points a ON c.customer_zip_code_prefix = a.zip
  LEFT JOIN points b ON s.seller_zip_code_prefix = b.zip)"""

_LABEL = ("replace(coalesce(product_category_name_english, product_category_name), '_', ' ')")
# All fixture labels are two words.
_TITLE2 = (f"array_to_string([upper(left(w, 1)) || lower(substr(w, 2)) FOR w IN"
           f" string_split({_LABEL}, ' ')], ' ')")
_PROMISED = days_between("order_purchase_timestamp", "order_estimated_delivery_date")
_ACTUAL = days_between("order_purchase_timestamp", "order_delivered_customer_date")
_MDIST = r(haversine("geolocation_lat_sell", "geolocation_lng_sell", "geolocation_lat_cust",
                     "geolocation_lng_cust"), 2)

MAPPED = JOINED + f""",
mapped AS (
  SELECT 'ORD-OLIST-' || printf('%07d', row_number() OVER (ORDER BY md5(concat_ws('|', order_id,
           order_item_id, product_id, seller_id)), price, freight_value))
           AS order_id,
    order_purchase_timestamp AS order_date, 'CUST-' || left(customer_id, 12) AS customer_id,
    CASE WHEN count(*) OVER (PARTITION BY customer_unique_id) > 1 THEN 'Returning' ELSE 'New' END
      AS customer_segment,
    'PROD-' || left(product_id, 12) AS product_id,
    CASE WHEN {_LABEL} IS NOT NULL THEN {_TITLE2} END AS product_category,
    order_item_id AS quantity, price AS unit_price, 0.0::DOUBLE AS discount_rate,
    product_weight_g / 1000e0 AS weight_kg, 'SELLER-' || left(seller_id, 8) AS origin_warehouse_id,
    seller_state AS origin_region, upper(left(customer_city, 1)) || substr(customer_city, 2)
      AS destination_city,
    'Brazil' AS destination_country, customer_state AS destination_region,
    geolocation_lat_cust AS destination_latitude, geolocation_lng_cust AS destination_longitude,
    {_MDIST} AS distance_km, 'Seller-' || left(seller_id, 6) AS carrier,
    NULL::VARCHAR AS shipping_mode, {_PROMISED} AS promised_delivery_days,
    {_ACTUAL} AS actual_delivery_days, freight_value AS shipping_cost,
    upper(order_status) AS order_status,
    CASE WHEN {_ACTUAL} IS NULL THEN 'Not delivered' WHEN {_ACTUAL} > {_PROMISED}
         THEN 'Late delivery' ELSE 'None' END AS delay_reason,
    order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
    order_delivered_customer_date
  FROM joined)"""

MILESTONE_SELECT = """
  SELECT order_id, carrier, t AS event_timestamp, k AS event_type, destination_city AS location,
    CASE WHEN k = 'DELIVERED' AND delay_reason = 'Late delivery' THEN 'Late delivery'
         ELSE 'None' END AS delay_reason
  FROM (
    SELECT *, order_purchase_timestamp AS t, 'ORDER_PLACED' AS k FROM mapped
    UNION ALL SELECT *, order_approved_at, 'PAYMENT_APPROVED' FROM mapped
    UNION ALL SELECT *, order_delivered_carrier_date, 'HANDED_TO_CARRIER' FROM mapped
    UNION ALL SELECT *, order_delivered_customer_date, 'DELIVERED' FROM mapped)
  WHERE t IS NOT NULL"""

MILESTONED = MAPPED + f""",
milestones AS ({MILESTONE_SELECT})"""

# --- vendor feed -----------------------------------------------------------

_VENDOR_VALUES = {
    "order_date": "strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')",
    "customer_id": "o_custkey::VARCHAR",
    "customer_segment": "c_mktsegment",
    "product_id": "l_partkey::VARCHAR",
    "product_category": "p_type",
    "quantity": ("CASE WHEN l_orderkey % 61 = 0 THEN 'n.a.' WHEN l_orderkey % 59 = 0 THEN"
                 " l_quantity::INTEGER || 'D' ELSE l_quantity::INTEGER::VARCHAR END"),
    "unit_price": "printf('%.2f', l_extendedprice)",
    "discount_rate": "printf('%.2f', l_discount)",
    "origin_warehouse_id": "CASE WHEN l_suppkey % 9 <> 0 THEN s_name END",
    "origin_region": "s_region",
    "destination_city": "'City ' || c_nk",
    "destination_country": "c_nation",
    "destination_region": "CASE WHEN c_custkey % 13 <> 0 THEN c_region END",
    "destination_latitude": "(-60 + 5 * c_nk)::VARCHAR",
    "destination_longitude": "(-150 + 12 * c_nk)::VARCHAR",
    "promised_delivery_days": "promised::VARCHAR",
    "actual_delivery_days": "taken::VARCHAR",
    "order_status": "o_orderstatus",
    "delay_reason": "CASE WHEN taken > promised THEN 'Late delivery' END",
}


def vendor(ids: str = "unique") -> str:
    """Canonical text columns of the vendor feed, before ids are assigned."""
    values = dict(_VENDOR_VALUES)
    if ids == "unique":
        values["order_id"] = "'LN/' || line_key"
    elif ids == "repeated":
        values["order_id"] = "l_orderkey::VARCHAR"
    else:
        del values["customer_id"], values["product_id"]
    body = ", ".join(f"{values.get(c, 'NULL::VARCHAR')} AS {c}" for c in ORDER_COLUMNS)
    return STAR + f""",
canonical AS (SELECT {body} FROM star)"""


def content_number(names, start: int = 1) -> str:
    text = ", ".join(f"coalesce({n}::VARCHAR, '')" for n in names)
    return f"(row_number() OVER (ORDER BY md5(concat_ws('|', {text}))) + {start - 1})"


def draw(name: str, seed: int = 42, key: str = "order_id") -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', {key}, '{name}', '{seed}')), 1, 8))::BIGINT"
            f" / 4294967296e0)")


def draw_int(name: str, low: int, high: int) -> str:
    return f"(floor({draw(name)} * {high - low})::INTEGER + ({low}))"


def draw_real(name: str, low: float, high: float) -> str:
    return f"({draw(name)} * ({high - low!r})::DOUBLE + ({low!r})::DOUBLE)"


def draw_choice(name: str, options) -> str:
    items = ", ".join(f"'{o}'" if isinstance(o, str) else f"{o!r}::DOUBLE" for o in options)
    return f"[{items}][{draw_int(name, 0, len(options))} + 1]"


LABEL_DEFAULT_SQL = ", ".join(f"coalesce({c}, '{d}') AS {c}" for c, d in LABEL_DEFAULTS.items())


def with_(clause: str, body: str) -> str:
    return f"WITH {clause.strip()}\n{body.strip()}"
