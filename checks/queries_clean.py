"""Cleaning (C01-C08, P19-P24)."""

from __future__ import annotations

from checks import sql as S, stages
from checks.registry import query
from haulmetrics.functions.numeric import round_even
from haulmetrics.operators.impute import fill_from_groups
from haulmetrics.plans import clean as plan
from haulmetrics.schema import ORDER_COLUMNS

_ALL = [*ORDER_COLUMNS, "source_system"]


@query("c01_distinct_orders", S.with_(S.LOCATED, f"SELECT {S.columns(_ALL)} FROM deduped"))
def distinct_orders(spark, sf):
    return plan.drop_copies(stages.raw(spark, sf))


@query("c02_distinct_events", S.with_(S.EVENTS, f"""
SELECT {S.columns(S.EVENT_COLUMNS)} FROM tracked"""))
def distinct_events(spark, sf):
    return plan.drop_copies(stages.tracking(spark, sf))


def _fill(name: str, column: str, join: str, digits: int = 6) -> None:
    sql = S.with_(S.LOCATED + f""",
grouped AS (
  SELECT l.order_id, coalesce(l.{column}, g.m) AS x FROM located l
  LEFT JOIN (SELECT {join}, median({column}) AS m FROM located GROUP BY {join}) g
    USING ({join}))""", f"""
SELECT order_id, {S.r('coalesce(x, (SELECT median(x) FROM grouped))', digits)} AS {column}
FROM grouped""")

    @query(name, sql)
    def run(spark, sf):
        rows = fill_from_groups(stages.survivors(spark, sf), [(column, join.split(", "))])
        return rows.select("order_id", round_even(column, digits).alias(column))


_fill("c03_impute_actual_days", "actual_delivery_days", "carrier, shipping_mode")
_fill("c04_impute_cost", "shipping_cost", "shipping_mode")
_fill("c05_impute_distance", "distance_km", "destination_region")
_fill("c06_impute_weight", "weight_kg", "product_category")


@query("c07_clean_report", S.with_(S.LOCATED, """
SELECT (SELECT count(*) FROM shipments_raw) AS input_rows,
  (SELECT count(*) FROM shipments_raw) - (SELECT count(*) FROM deduped) AS duplicates_removed,
  (SELECT count(*) FROM deduped) - (SELECT count(*) FROM dated) AS invalid_dates_dropped,
  (SELECT count(*) FILTER (shipping_mode IS NULL) FROM dated) AS missing_shipping_mode_before,
  (SELECT count(*) FROM dated) - count(*) AS invalid_coordinates_removed,
  count(*) FILTER (actual_delivery_days IS NULL) AS missing_actual_delivery_days_before,
  count(*) FILTER (shipping_cost IS NULL) AS missing_shipping_cost_before,
  count(*) FILTER (distance_km IS NULL) AS missing_distance_km_before,
  count(*) FILTER (weight_kg IS NULL) AS missing_weight_kg_before,
  count(*) AS output_rows,
  (SELECT count(*) FROM shipments_raw) - count(*) AS rows_dropped_total
FROM located"""))
def clean_report(spark, sf):
    return plan.clean_report(stages.raw(spark, sf))


_CLEAN_ALL = f"""
SELECT * REPLACE (strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date)
FROM (SELECT {S.columns(_ALL)} FROM clean)"""


@query("c08_clean_orders", S.with_(S.CLEAN, _CLEAN_ALL))
def clean_orders(spark, sf):
    return plan.clean_orders(stages.raw(spark, sf))


@query("c08_clean_events", S.with_(S.EVENTS, f"SELECT {S.EVENT_TEXT} FROM clean_events"))
def clean_events(spark, sf):
    return plan.clean_events(stages.tracking(spark, sf))


@query("p19_valid_dates", S.with_(S.LOCATED, """
SELECT order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date FROM dated"""))
def valid_dates(spark, sf):
    rows = plan.parse_order_dates(plan.drop_copies(stages.raw(spark, sf)))
    return rows.where("order_date is not null").select("order_id", "order_date")


@query("p20_standard_text", S.with_(S.LOCATED, f"""
SELECT order_id, {S.title_word(S.strip('product_category'))} AS product_category,
  {S.strip('carrier')} AS carrier, upper({S.strip('order_status')}) AS order_status
FROM shipments_raw"""))
def standard_text(spark, sf):
    return plan.standardise_text(stages.raw(spark, sf)).select(
        "order_id", "product_category", "carrier", "order_status")


@query("p21_inferred_mode", S.with_(S.RAW, f"""
SELECT order_id, coalesce(shipping_mode, {S.MODE_CASE}, 'Standard Class') AS shipping_mode
FROM shipments_raw"""))
def inferred_mode(spark, sf):
    return plan.infer_shipping_mode(stages.raw(spark, sf)).select("order_id", "shipping_mode")


@query("c07_rejected_rows", S.with_(S.RAW, """
SELECT step, CASE step WHEN 'dates' THEN 'no readable order date'
    ELSE 'position missing or off the globe' END AS reason, copies, order_id, order_date, carrier,
  product_category, destination_latitude, destination_longitude
FROM (SELECT *, CASE WHEN try_strptime(order_date, '%Y-%m-%d') IS NULL THEN 'dates'
    WHEN NOT coalesce(destination_latitude BETWEEN -90 AND 90
      AND destination_longitude BETWEEN -180 AND 180, false) THEN 'coordinates' END AS step
  FROM (SELECT *, count(*) AS copies FROM shipments_raw GROUP BY ALL)) WHERE step IS NOT NULL"""))
def rejected_rows(spark, sf):
    return plan.routed(stages.raw(spark, sf))[2].select(
        "step", "reason", "copies", "order_id", "order_date", "carrier", "product_category",
        "destination_latitude", "destination_longitude")


@query("p22_default_category", S.with_(S.RAW, """
SELECT order_id, coalesce(product_category, 'Unknown') AS product_category FROM shipments_raw"""))
def default_category(spark, sf):
    return plan.default_category(stages.raw(spark, sf)).select("order_id", "product_category")


@query("p23_valid_coordinates", S.with_(S.RAW, """
SELECT order_id, destination_latitude, destination_longitude FROM shipments_raw
WHERE destination_latitude BETWEEN -90 AND 90 AND destination_longitude BETWEEN -180 AND 180"""))
def valid_coordinates(spark, sf):
    return stages.raw(spark, sf).where(plan.valid_coordinates()).select(
        "order_id", "destination_latitude", "destination_longitude")


@query("p24_converted_types", S.with_(S.RAW, f"""
SELECT order_id, trunc(quantity)::BIGINT AS quantity,
  {S.r('actual_delivery_days')}::BIGINT AS actual_delivery_days,
  trunc(promised_delivery_days)::BIGINT AS promised_delivery_days,
  {S.r('unit_price', 2)} AS unit_price, {S.r('shipping_cost', 2)} AS shipping_cost
FROM shipments_raw"""))
def converted_types(spark, sf):
    return plan.convert_types(stages.raw(spark, sf)).select(
        "order_id", "quantity", "actual_delivery_days", "promised_delivery_days", "unit_price",
        "shipping_cost")
