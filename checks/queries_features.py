"""Per-row and per-group features (P25-P29, W02-W09, J08, J12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as S, stages
from checks.registry import query
from haulmetrics.functions.numeric import round_even
from haulmetrics.plans import features as plan, increments
from haulmetrics.plans.analytics import with_month
from haulmetrics.schema import FEATURE_COLUMNS
from haulmetrics.session import stage


def _feature(columns: str) -> str:
    return S.with_(S.FEATURED, f"SELECT order_id, {columns} FROM featured")


def _base(spark, sf):
    return plan.add_delay(stages.clean(spark, sf))


@query("p25_delay", _feature("delivery_delay, is_delayed"))
def delay(spark, sf):
    return _base(spark, sf).select("order_id", "delivery_delay", "is_delayed")


@query("p26_cost_per_unit", _feature("shipping_cost_per_unit"))
def cost_per_unit(spark, sf):
    return plan.add_cost_per_unit(stages.clean(spark, sf)).select("order_id",
                                                                  "shipping_cost_per_unit")


@query("p27_distance_category", _feature("distance_category"))
def distance_category(spark, sf):
    return plan.add_bins(stages.clean(spark, sf)).select("order_id", "distance_category")


@query("p28_shipment_size", _feature("shipment_size_category"))
def shipment_size(spark, sf):
    return plan.add_bins(stages.clean(spark, sf)).select("order_id", "shipment_size_category")


@query("p29_order_month", _feature("strftime(order_date, '%Y-%m') AS order_month"))
def order_month(spark, sf):
    return with_month(stages.clean(spark, sf)).select("order_id", "order_month")


@query("w02_route_efficiency", _feature("route_efficiency_score"))
def route_efficiency(spark, sf):
    rows = stages.clean(spark, sf)
    speeds = plan.stage(plan.region_speed(rows), "region_speed")
    return plan.add_route_efficiency(rows, speeds).select("order_id", "route_efficiency_score")


@query("w03_carrier_score", S.with_(S.FEATURED, """
SELECT carrier, count(*) AS orders, min(carrier_performance_score) AS score FROM featured
GROUP BY 1"""))
def carrier_score(spark, sf):
    lateness = plan.lateness_by_carrier_category(_base(spark, sf))
    return plan.carrier_scores(lateness).select(
        "carrier", F.col("rows").alias("orders"),
        F.col("carrier_performance_score").alias("score"))


@query("w04_seasonal_index", S.with_(S.FEATURED, """
SELECT strftime(order_month, '%Y-%m-%d') AS order_month, count(*) AS orders,
  min(seasonal_demand_index) AS score FROM featured GROUP BY 1"""))
def seasonal_index(spark, sf):
    months = plan.month_index(plan.daily_category_units(stages.clean(spark, sf)))
    return months.select("order_month", F.col("rows").alias("orders"),
                         F.col("seasonal_demand_index").alias("score"))


@query("w05_warehouse_utilization", S.with_(S.FEATURED, """
SELECT origin_warehouse_id, strftime(order_day, '%Y-%m-%d') AS order_day,
  max(wh_units)::BIGINT AS units, max(warehouse_utilization) AS utilization
FROM featured GROUP BY 1, 2"""))
def warehouse_utilization(spark, sf):
    daily = plan.daily_warehouse_units(stages.clean(spark, sf))
    return plan.warehouse_load(daily, plan.capacity_table(spark)).select(
        "origin_warehouse_id", "order_day", "units",
        F.col("warehouse_utilization").alias("utilization"))


@query("w06_inventory_turnover", S.with_(S.FEATURED, """
SELECT product_category, strftime(order_day, '%Y-%m-%d') AS order_day,
  min(inventory_turnover) AS turnover FROM featured GROUP BY 1, 2"""))
def inventory_turnover(spark, sf):
    daily = plan.stage(plan.daily_category_units(stages.clean(spark, sf)), "category_days")
    return plan.category_days(daily, plan.month_index(daily)).select(
        "product_category", "order_day", F.col("inventory_turnover").alias("turnover"))


def _risk(spark, sf):
    rows = _base(spark, sf)
    lateness = plan.stage(plan.lateness_by_carrier_category(rows), "lateness")
    daily = plan.stage(plan.daily_category_units(rows), "category_days")
    volatility = plan.category_volatility(daily, plan.month_index(daily))
    return lateness, volatility


@query("w07_pair_late_share", S.with_(S.FEATURED, f"""
SELECT carrier, product_category, {S.r('min(pair_late)', 6)} AS late_share FROM featured
GROUP BY 1, 2"""))
def pair_late_share(spark, sf):
    return plan.pair_scores(*_risk(spark, sf)).select(
        "carrier", "product_category", round_even("pair_late_share", 6).alias("late_share"))


@query("w08_demand_volatility", S.with_(S.FEATURED, f"""
SELECT product_category, {S.r('min(vol)', 6)} AS volatility,
  {S.r('min(vol_scaled)', 6)} AS scaled FROM featured GROUP BY 1"""))
def demand_volatility(spark, sf):
    return _risk(spark, sf)[1].select(
        "product_category", round_even("volatility", 6).alias("volatility"),
        round_even("volatility_scaled", 6).alias("scaled"))


@query("w09_reorder_risk", S.with_(S.FEATURED, """
SELECT DISTINCT carrier, product_category, carrier_performance_score, reorder_risk_score
FROM featured"""))
def reorder_risk(spark, sf):
    return plan.pair_scores(*_risk(spark, sf)).select(
        "carrier", "product_category", "carrier_performance_score", "reorder_risk_score")


_FEATURES = ", ".join(FEATURE_COLUMNS)


@query("w02_w09_featured_orders", _feature(_FEATURES))
def featured_orders(spark, sf):
    return plan.engineer_features(stages.clean(spark, sf)).select("order_id", *FEATURE_COLUMNS)


@query("w02_w09_features_of_new_months", S.with_(S.FEATURED, f"""
SELECT order_id, {_FEATURES} FROM featured WHERE month(order_date) % 3 = 2"""))
def features_of_new_months(spark, sf):
    """Features of the orders of the last batch; of those before, only partial aggregates are read."""
    rows = stage(stages.clean(spark, sf).where(F.month("order_date") % 3 == 2), "new_months")
    known = increments.statistics(spark, stages.kept(spark, sf))
    return plan.engineer_features(rows, known).select("order_id", *FEATURE_COLUMNS)


@query("j08_capacity_lookup", S.with_(S.FEATURED, """
SELECT f.origin_warehouse_id, coalesce(c.capacity_units_per_day, max(wh_units))::BIGINT AS capacity
FROM featured f LEFT JOIN capacity c ON f.origin_warehouse_id = c.warehouse_id
GROUP BY f.origin_warehouse_id, c.capacity_units_per_day"""))
def capacity_lookup(spark, sf):
    daily = plan.daily_warehouse_units(stages.clean(spark, sf))
    load = plan.warehouse_load(daily, plan.capacity_table(spark))
    return load.select("origin_warehouse_id", "capacity").distinct()


@query("j12_group_result_on_rows", S.with_(S.FEATURED, f"""
SELECT order_id, {S.r('avg(delivery_delay) OVER (PARTITION BY carrier)', 6)} AS carrier_delay
FROM featured"""))
def group_result_on_rows(spark, sf):
    rows = _base(spark, sf).select("order_id", "carrier", "delivery_delay")
    out = plan.attach_group_mean(rows, ["carrier"], "delivery_delay", "carrier_delay")
    return out.select("order_id", round_even("carrier_delay", 6).alias("carrier_delay"))
