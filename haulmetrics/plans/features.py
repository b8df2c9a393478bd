"""Per-shipment features.

Row expressions are plain columns. Group statistics come from four narrow
aggregations of the cleaned table (region; carrier x category; category x day;
warehouse x day); coarser ones are rolled up from those small results, and
each result is attached with one join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmetrics.functions.dates import day
from haulmetrics.functions.numeric import binned, ratio, round_even
from haulmetrics.operators.attach import attach
from haulmetrics.operators.quantiles import exact_median
from haulmetrics.schema import (DISTANCE_BINS, FEATURE_COLUMNS, SIZE_BINS, WAREHOUSE_CAPACITY,
                                WAREHOUSE_SCHEMA)
from haulmetrics.session import stage

def speed() -> Column:
    """Kilometres per day of actual delivery; null for same-day deliveries."""
    return ratio("distance_km", "actual_delivery_days")


def capacity_table(spark: SparkSession) -> DataFrame:
    """The fixed eight warehouses."""
    return spark.createDataFrame(WAREHOUSE_CAPACITY, WAREHOUSE_SCHEMA)


def add_delay(df: DataFrame) -> DataFrame:
    """Days late and the flag; an unknown delay counts as not late."""
    delay = F.col("actual_delivery_days") - F.col("promised_delivery_days")
    return df.withColumns({
        "delivery_delay": delay,
        "is_delayed": F.coalesce((delay > 0).cast("int"), F.lit(0)),
    })


def cost_per_unit() -> Column:
    return round_even(ratio("shipping_cost", "quantity"), 3)


def median_cost(df: DataFrame, **options) -> float | None:
    """Median cost per unit; None where every row has one of its own."""
    costs = df.select(cost_per_unit().alias("cost"))
    if costs.where("cost is null").isEmpty():
        return None
    return exact_median(costs, "cost", **options)


def add_cost_per_unit(df: DataFrame, fallback: float | None = None, **options) -> DataFrame:
    """Cost per unit; where it cannot be computed, ``fallback``, else the median of all others."""
    if fallback is None:
        fallback = median_cost(df, **options)
    return df.withColumn("shipping_cost_per_unit",
                         F.coalesce(cost_per_unit(), F.lit(fallback).cast("double")))


def add_bins(df: DataFrame) -> DataFrame:
    bulk = F.col("weight_kg") * F.col("quantity")
    return df.withColumns({
        "distance_category": binned("distance_km", DISTANCE_BINS, low=0),
        "shipment_size_category": binned(bulk, SIZE_BINS, low=0),
    })


# --- group statistics ----------------------------------------------------

def region_speed(df: DataFrame) -> DataFrame:
    """Slowest and fastest km per day of each destination region."""
    return (df.select("destination_region", speed().alias("speed"))
            .groupBy("destination_region")
            .agg(F.min("speed").alias("speed_min"), F.max("speed").alias("speed_max"),
                 F.count("*").alias("rows")))


def add_route_efficiency(df: DataFrame, speeds: DataFrame) -> DataFrame:
    """Speed scaled to 0..1 within its region; 0.5 throughout a region without spread."""
    rows = attach(df, speeds, ["destination_region"], weight="rows")
    span = F.col("speed_max") - F.col("speed_min")
    score = F.when(span > 0, (speed() - F.col("speed_min")) / span).otherwise(F.lit(0.5))
    known = F.col("destination_region").isNotNull()
    return (rows.withColumn("route_efficiency_score", F.when(known, round_even(score, 4)))
            .drop("speed_min", "speed_max"))


def lateness_by_carrier_category(df: DataFrame) -> DataFrame:
    return df.groupBy("carrier", "product_category").agg(
        F.sum("is_delayed").alias("late"), F.count("*").alias("rows"))


def carrier_scores(lateness: DataFrame) -> DataFrame:
    """On-time share per carrier, rolled up from carrier x category."""
    return (lateness.groupBy("carrier")
            .agg(F.sum("late").alias("late"), F.sum("rows").alias("rows"))
            .select("carrier", "rows", round_even(1 - F.col("late") / F.col("rows"), 4)
                    .alias("carrier_performance_score")))


def daily_category_units(df: DataFrame) -> DataFrame:
    return df.groupBy("product_category", day("order_date").alias("order_day")).agg(
        F.sum("quantity").alias("units"), F.count("quantity").alias("counted"),
        F.count("order_id").alias("orders"), F.count("*").alias("rows"))


def month_index(daily: DataFrame) -> DataFrame:
    """Orders of a month relative to the mean of the months present."""
    months = (daily.where("order_day is not null")
              .groupBy(F.trunc("order_day", "month").alias("order_month"))
              .agg(F.sum("orders").alias("orders"), F.sum("rows").alias("rows")))
    mean = months.agg(F.avg("orders")).scalar()
    return months.select("order_month", "rows", round_even(ratio("orders", mean), 4)
                         .alias("seasonal_demand_index"))


def category_days(daily: DataFrame, months: DataFrame) -> DataFrame:
    """Turnover and seasonal index per (category, day).

    Turnover is the units of the day over thirty mean quantities of the
    category. The window holds one row per day of a category.
    """
    category = Window.partitionBy("product_category")
    mean = F.sum("units").over(category) / F.sum("counted").over(category)
    turnover = F.when(F.col("product_category").isNotNull(),
                      round_even(ratio("units", mean * 30), 4))
    rows = daily.select("product_category", "order_day", "rows",
                        F.trunc("order_day", "month").alias("order_month"),
                        turnover.alias("inventory_turnover"))
    return rows.join(months.drop("rows"), "order_month", "left").drop("order_month")


def category_volatility(daily: DataFrame, months: DataFrame) -> DataFrame:
    """Spread of the seasonal index over the rows of a category, scaled over all categories.

    The spread is a count-weighted sample deviation over (category, month)
    counts, in two passes for accuracy.
    """
    counts = (daily.where("product_category is not null")
              .groupBy("product_category", F.trunc("order_day", "month").alias("order_month"))
              .agg(F.sum("rows").alias("n")))
    counts = counts.join(months.select("order_month", F.col("seasonal_demand_index").alias("x")),
                         "order_month")
    # One row per month of a category.
    category = Window.partitionBy("product_category")
    total = F.sum("n").over(category)
    mean = F.sum(F.col("n") * F.col("x")).over(category) / total
    squares = F.sum(F.col("n") * F.pow(F.col("x") - F.col("mean"), 2))
    spread = (counts.select("product_category", "n", "x", total.alias("total"),
                            mean.alias("mean"))
              .groupBy("product_category", "total")
              .agg(F.coalesce(F.sqrt(F.try_divide(squares, F.col("total") - 1)), F.lit(0.0))
                   .alias("volatility")))
    ends = spread.agg(F.struct(F.min("volatility").alias("low"),
                               F.max("volatility").alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    return spread.select("product_category", "volatility",
                         ((F.col("volatility") - low) / (high - low + F.lit(1e-9)))
                         .alias("volatility_scaled"))


def pair_scores(lateness: DataFrame, volatility: DataFrame) -> DataFrame:
    """Scores per (carrier, category): the carrier's on-time share and the reorder risk.

    The risk is 0.65 of the pair's late share plus 0.35 of the category's
    scaled volatility; it is unknown where carrier or category is.
    """
    late_share = F.when(F.col("carrier").isNotNull() & F.col("product_category").isNotNull(),
                        F.col("late") / F.col("rows"))
    risk = round_even(0.65 * F.col("pair_late_share") + 0.35 * F.col("volatility_scaled"), 4)
    return (lateness.withColumn("pair_late_share", late_share)
            .join(carrier_scores(lateness).drop("rows"), "carrier", "left")
            .join(volatility, "product_category", "left")
            .select("carrier", "product_category", "rows", "carrier_performance_score",
                    "pair_late_share", risk.alias("reorder_risk_score")))


def daily_warehouse_units(df: DataFrame) -> DataFrame:
    return df.groupBy("origin_warehouse_id", day("order_date").alias("order_day")).agg(
        F.sum("quantity").alias("units"), F.count("*").alias("rows"))


def warehouse_load(daily: DataFrame, capacity: DataFrame) -> DataFrame:
    """Units of a warehouse on a day over its capacity, else over its busiest day.

    The window holds one row per day of a warehouse.
    """
    listed = F.broadcast(capacity.select(F.col("warehouse_id").alias("origin_warehouse_id"),
                                         "capacity_units_per_day"))
    peak = F.max("units").over(Window.partitionBy("origin_warehouse_id"))
    limit = F.nullif(F.coalesce("capacity_units_per_day", "peak"), F.lit(0))
    return (daily.withColumn("peak", peak).join(listed, "origin_warehouse_id", "left")
            .withColumn("capacity", limit)
            .select("origin_warehouse_id", "order_day", "rows", "units", "capacity",
                    round_even(ratio("units", "capacity"), 4).alias("warehouse_utilization")))


# --- the stage -----------------------------------------------------------

@dataclass(frozen=True)
class GroupStatistics:
    """The staged aggregations that the features of any rows are computed from.

    ``median_cost`` stands for a cost per unit that cannot be computed; None: the median of
    the rows at hand.
    """

    speeds: DataFrame
    lateness: DataFrame
    category_units: DataFrame
    warehouse_units: DataFrame
    median_cost: float | None = None


def group_statistics(orders: DataFrame) -> GroupStatistics:
    base = add_delay(orders)
    return GroupStatistics(stage(region_speed(base), "region_speed"),
                           stage(lateness_by_carrier_category(base), "lateness"),
                           stage(daily_category_units(base), "category_units"),
                           daily_warehouse_units(base))


def engineer_features(orders: DataFrame, statistics: GroupStatistics | None = None,
                      **options) -> DataFrame:
    """All features on the cleaned orders, which should be a stored table.

    With ``statistics`` of a larger table that holds these orders, such as those that
    ``increments`` keeps, the features are those the orders have in that table.
    """
    spark, columns = orders.sparkSession, orders.columns
    known = statistics or group_statistics(orders)
    daily = known.category_units
    months = stage(month_index(daily), "months")
    pairs = stage(pair_scores(known.lateness, category_volatility(daily, months))
                  .drop("pair_late_share"), "pairs")
    days = stage(category_days(daily, months), "category_days")
    load = stage(warehouse_load(known.warehouse_units, capacity_table(spark))
                 .drop("units", "capacity"), "load")

    # this table may be too large to broadcast, so its join comes while rows are narrow
    rows = attach(orders.withColumn("order_day", day("order_date")), load,
                  ["origin_warehouse_id", "order_day"], weight="rows")
    fallback = known.median_cost
    if fallback is None:
        fallback = median_cost(orders, **options)
    cost = F.coalesce(cost_per_unit(), F.lit(fallback).cast("double"))
    rows = add_bins(add_delay(rows).withColumn("shipping_cost_per_unit", cost))
    rows = add_route_efficiency(rows, known.speeds)
    rows = attach(rows, pairs, ["carrier", "product_category"], weight="rows", null_safe=True)
    rows = attach(rows, days, ["product_category", "order_day"], weight="rows", null_safe=True)
    return rows.select(*columns, *FEATURE_COLUMNS)


def attach_group_mean(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Group mean on every row; rows with a missing key get null."""
    stats = stage(df.groupBy(*keys).agg(F.avg(value).alias(name), F.count("*").alias("rows")),
                  "group_mean")
    return attach(df, stats, keys, weight="rows")
