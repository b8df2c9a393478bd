"""Aggregates, trend, report, exploration and split (A, W01, T, M, U03, J10, J11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as S, stages
from checks.registry import query
from haulmetrics.functions.hashing import stable_fraction
from haulmetrics.functions.numeric import round_even
from haulmetrics.plans import analytics, increments, report, split
from haulmetrics.schema import (DISTANCE_LABELS, FEATURE_COLUMNS, SPLIT_FEATURES, SPLIT_IDS,
                                SPLIT_TARGETS)
from haulmetrics.sources.json_pages import explode_rates

_MODEL = [*SPLIT_IDS, *SPLIT_FEATURES, *SPLIT_TARGETS]


def _featured(body: str) -> str:
    return S.with_(S.FEATURED, body)


def _rounded(df, columns, digits=6):
    return df.withColumns({c: round_even(c, digits) for c in columns})


_CARRIER_MONTH = f"""
SELECT carrier, strftime(order_date, '%Y-%m') AS order_month, count(order_id) AS order_count,
  {S.r('avg(is_delayed)', 8)} AS on_time_violation_rate,
  {S.r('avg(delivery_delay)', 8)} AS avg_delivery_delay_days,
  {S.r('avg(shipping_cost_per_unit)', 8)} AS avg_shipping_cost_per_unit,
  {S.r('avg(carrier_performance_score)', 8)} AS avg_carrier_performance_score
FROM featured GROUP BY 1, 2"""


_CARRIER_MEANS = ["on_time_violation_rate", "avg_delivery_delay_days",
                  "avg_shipping_cost_per_unit", "avg_carrier_performance_score"]


def carrier_month_rounded(featured):
    return _rounded(analytics.carrier_month(featured), _CARRIER_MEANS, digits=8)


@query("a02_carrier_month", _featured(_CARRIER_MONTH))
def carrier_month(spark, sf):
    return carrier_month_rounded(stages.featured(spark, sf))


@query("a02_carrier_month_kept", _featured(_CARRIER_MONTH))
def carrier_month_kept(spark, sf):
    """From the store of partial aggregates, one batch of which came wrong at first."""
    return _rounded(increments.carrier_month(spark, stages.kept(spark, sf)), _CARRIER_MEANS,
                    digits=8)


@query("a03_region_delays_kept", _featured(f"""
SELECT destination_region, distance_category, count(order_id) AS order_count,
  {S.r('avg(is_delayed)', 6)} AS delay_rate, {S.r('avg(distance_km)', 6)} AS avg_distance_km
FROM featured GROUP BY 1, 2"""))
def region_delays_kept(spark, sf):
    return _rounded(increments.region_delays(spark, stages.kept(spark, sf)),
                    ["delay_rate", "avg_distance_km"])


_REGION_ROUTE = f"""
SELECT destination_region, distance_category, count(order_id) AS order_count,
  {S.r('avg(route_efficiency_score)', 6)} AS avg_route_efficiency_score,
  {S.r('avg(is_delayed)', 6)} AS delay_rate, {S.r('avg(distance_km)', 6)} AS avg_distance_km
FROM featured GROUP BY 1, 2"""


@query("a03_region_route", _featured(_REGION_ROUTE))
def region_route(spark, sf):
    return _rounded(analytics.region_route(stages.featured(spark, sf)),
                    ["avg_route_efficiency_score", "delay_rate", "avg_distance_km"])


@query("t01_ordered_results", _featured(f"""
SELECT destination_region, distance_category, row_number() OVER
  (ORDER BY destination_region NULLS FIRST, distance_category NULLS FIRST) AS position
FROM ({_REGION_ROUTE})"""))
def ordered_results(spark, sf):
    """The place at which each row comes out."""
    return report.with_position(analytics.region_route(stages.featured(spark, sf))).select(
        "destination_region", "distance_category", "position")


@query("w01_rolling_delay", _featured(f"""
SELECT order_id, carrier, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, delivery_delay,
  {S.r('avg(delivery_delay) OVER (PARTITION BY carrier ORDER BY order_date, md5(order_id), order_id'
       ' ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 6)} AS rolling_avg_delay_7orders
FROM featured"""))
def rolling_delay(spark, sf):
    return _rounded(analytics.rolling_delay(stages.featured(spark, sf)),
                    ["rolling_avg_delay_7orders"])


@query("a04_class_balance", _featured(f"""
SELECT is_delayed, {S.r('count(*) / (SELECT count(is_delayed) FROM featured)', 4)} AS share
FROM featured GROUP BY 1"""))
def class_balance(spark, sf):
    return split.class_balance(stages.featured(spark, sf))


@query("a05_delay_stats", _featured(f"""
SELECT {S.r('avg(delivery_delay)', 3)} AS mean, median(delivery_delay)::DOUBLE AS median,
  {S.r('stddev_samp(delivery_delay)', 3)} AS std, min(delivery_delay)::DOUBLE AS min,
  max(delivery_delay)::DOUBLE AS max FROM featured"""))
def delay_stats(spark, sf):
    return report.delay_stats(stages.featured(spark, sf))


@query("a06_on_time_by_carrier", _featured(f"""
SELECT carrier, {S.r('1 - avg(is_delayed)', 4)} AS on_time_rate FROM featured GROUP BY 1"""))
def on_time_by_carrier(spark, sf):
    return report.on_time_by_carrier(stages.featured(spark, sf))


@query("a07_orders_by_region", _featured("""
SELECT destination_region, count(*) AS orders FROM featured GROUP BY 1 ORDER BY 2 DESC, 1"""))
def orders_by_region(spark, sf):
    return report.counts_by(stages.featured(spark, sf), "destination_region")


@query("a07_orders_by_category", _featured("""
SELECT product_category, count(*) AS orders FROM featured GROUP BY 1 ORDER BY 2 DESC, 1"""))
def orders_by_category(spark, sf):
    return report.counts_by(stages.featured(spark, sf), "product_category")


@query("a08_delay_by_distance", _featured(f"""
SELECT distance_category, {S.r('avg(delivery_delay)', 3)} AS avg_delay FROM featured GROUP BY 1"""))
def delay_by_distance(spark, sf):
    return report.delay_by_distance(stages.new_features(spark, sf))


@query("a09_orders_by_month", _featured("""
SELECT strftime(order_date, '%Y-%m') AS month, count(order_id) AS orders FROM featured
GROUP BY 1"""))
def orders_by_month(spark, sf):
    return report.orders_by_month(stages.featured(spark, sf))


@query("a10_kpis", _featured(f"""
SELECT *, format('{{:,}}', total_orders) AS total_orders_text, on_time_pct || '%' AS on_time_text,
  avg_delay || ' days' AS avg_delay_text,
  '$' || format('{{:,}}', round_even(total_cost, 0)::BIGINT) AS total_cost_text
FROM (SELECT count(*) AS total_orders, {S.r('100 * (1 - avg(is_delayed))', 1)} AS on_time_pct,
        {S.r('avg(delivery_delay)', 2)} AS avg_delay, {S.r('sum(shipping_cost)', 2)} AS total_cost
      FROM featured)"""))
def kpis(spark, sf):
    return report.kpis(stages.featured(spark, sf))


@query("a11_monthly_trend", _featured(f"""
SELECT strftime(order_date, '%Y-%m') AS month, count(order_id) AS orders,
  {S.r('avg(delivery_delay)', 2)} AS avg_delay FROM featured GROUP BY 1 ORDER BY 1"""))
def monthly_trend(spark, sf):
    return report.monthly_trend(stages.featured(spark, sf))


_CARRIER_TABLE = f"""
SELECT carrier, {S.r('100 * (1 - avg(is_delayed))', 1)} AS on_time_rate,
  {S.r('avg(shipping_cost_per_unit)', 2)} AS avg_cost_per_unit, count(order_id) AS orders
FROM featured GROUP BY 1 ORDER BY 2, 1"""


@query("a12_carrier_table", _featured(_CARRIER_TABLE))
def carrier_table(spark, sf):
    return report.carrier_table(stages.featured(spark, sf))


@query("t03_ordered_by_aggregate", _featured(f"""
SELECT carrier, row_number() OVER (ORDER BY on_time_rate, carrier) AS position
FROM ({_CARRIER_TABLE})"""))
def ordered_by_aggregate(spark, sf):
    """The place at which each row comes out."""
    return report.with_position(report.carrier_table(stages.featured(spark, sf))).select(
        "carrier", "position")


@query("a13_region_table", _featured(f"""
SELECT destination_region, {S.r('100 * avg(is_delayed)', 1)} AS delay_rate,
  count(order_id) AS orders FROM featured GROUP BY 1 ORDER BY 2 DESC, 1"""))
def region_table(spark, sf):
    return report.region_table(stages.featured(spark, sf))


_ALIGNED = f"""
SELECT o.label AS distance_category, o.position, g.avg_delay
FROM (VALUES ('Local', 1), ('Regional', 2), ('Long-Haul', 3), ('International', 4))
  AS o(label, position)
LEFT JOIN (SELECT distance_category, {S.r('avg(delivery_delay)', 2)} AS avg_delay FROM featured
           GROUP BY 1) g ON o.label = g.distance_category"""


@query("a14_delay_by_distance_ordered", _featured(_ALIGNED))
def delay_by_distance_ordered(spark, sf):
    return report.delay_by_distance_ordered(stages.featured(spark, sf))


@query("j10_fixed_label_order", _featured(_ALIGNED.replace(
    "('International', 4))", "('International', 4), ('Orbital', 5))")))
def fixed_label_order(spark, sf):
    """The last label has no rows and must survive with a null."""
    return report.delay_by_distance_ordered(stages.featured(spark, sf),
                                            [*DISTANCE_LABELS, "Orbital"])


@query("t04_top_categories", _featured("""
SELECT product_category, false AS is_rest, orders FROM
  (SELECT product_category, count(*) AS orders, row_number() OVER
     (ORDER BY count(*) DESC, product_category) AS rn FROM featured GROUP BY 1) WHERE rn <= 7
UNION ALL SELECT 'Other', true, sum(orders)::BIGINT FROM
  (SELECT count(*) AS orders, row_number() OVER (ORDER BY count(*) DESC, product_category) AS rn
   FROM featured GROUP BY product_category) WHERE rn > 7 HAVING count(*) > 0"""))
def top_categories(spark, sf):
    return report.top_categories(stages.featured(spark, sf))


@query("t04_top_warehouses_and_rest", S.with_(S.FEATURED + """,
ranked AS (SELECT origin_warehouse_id, count(*) AS orders, row_number() OVER
  (ORDER BY count(*) DESC, origin_warehouse_id) AS rn FROM featured GROUP BY 1)""", """
SELECT CASE WHEN rn > 7 THEN 'Other' ELSE origin_warehouse_id END AS origin_warehouse_id,
  rn > 7 AS is_rest, sum(orders)::BIGINT AS orders FROM ranked GROUP BY 1, 2"""))
def top_warehouses(spark, sf):
    counts = report.counts_by(stages.featured(spark, sf), "origin_warehouse_id")
    return report.top_with_rest(counts, "origin_warehouse_id", "orders")


@query("t06_first_rows", S.with_(S.SPLIT, f"""
SELECT * REPLACE (strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date)
FROM (SELECT {S.columns(_MODEL)} FROM train ORDER BY order_id LIMIT 5)"""))
def first_rows(spark, sf):
    rows = split.modelling_table(stages.new_features(spark, sf))
    return split.train_test(rows)[0].orderBy("order_id").limit(5)


@query("a16_carrier_exploration", S.with_(S.SPLIT, f"""
SELECT carrier, count(*) AS orders, {S.r('1 - avg(is_delayed)', 4)} AS on_time_rate,
  {S.r('avg(delivery_delay)', 3)} AS avg_delay_days,
  {S.r('avg(shipping_cost_per_unit)', 2)} AS avg_cost_per_unit
FROM train GROUP BY 1 ORDER BY 3 DESC, 1"""))
def carrier_exploration(spark, sf):
    return report.carrier_exploration(stages.new_train(spark, sf))


@query("a17_distance_exploration", S.with_(S.SPLIT, f"""
SELECT distance_category, count(*) AS orders, {S.r('avg(delivery_delay)', 3)} AS avg_delay_days,
  {S.r('avg(route_efficiency_score)', 3)} AS avg_route_efficiency
FROM train GROUP BY 1 ORDER BY 3 DESC, 1"""))
def distance_exploration(spark, sf):
    return report.distance_exploration(stages.train(spark, sf))


@query("a18_describe_delay", S.with_(S.SPLIT, f"""
SELECT count(delivery_delay)::DOUBLE AS count, {S.r('avg(delivery_delay)', 3)} AS mean,
  {S.r('stddev_samp(delivery_delay)', 3)} AS std, min(delivery_delay)::DOUBLE AS min,
  {S.r('quantile_cont(delivery_delay, 0.25)', 3)} AS p25,
  {S.r('quantile_cont(delivery_delay, 0.5)', 3)} AS p50,
  {S.r('quantile_cont(delivery_delay, 0.75)', 3)} AS p75,
  max(delivery_delay)::DOUBLE AS max FROM train"""))
def describe_delay(spark, sf):
    return report.describe(stages.train(spark, sf))


_KNOWN = "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS known FROM featured"
                             for c in FEATURE_COLUMNS)


@query("a18_known_by_feature", _featured(_KNOWN))
def known_by_feature(spark, sf):
    return report.known_by_column(stages.featured(spark, sf), FEATURE_COLUMNS)


_NUMERIC = ["quantity", "unit_price", "discount_rate", "weight_kg", "distance_km",
            "promised_delivery_days", "shipping_cost", "shipping_cost_per_unit",
            "route_efficiency_score", "carrier_performance_score", "seasonal_demand_index",
            "warehouse_utilization", "inventory_turnover", "reorder_risk_score"]
_CORR = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {S.r(f'corr({c}, delivery_delay)', 3)} AS corr_with_delivery_delay"
    f" FROM train" for c in _NUMERIC)


@query("a19_correlations", S.with_(S.SPLIT, _CORR))
def correlations(spark, sf):
    return report.correlations(stages.train(spark, sf))


@query("a20_delay_histogram", S.with_(S.SPLIT, """
SELECT b.bin, {0} AS low, {1} AS high, coalesce(c.orders, 0) AS orders
FROM (SELECT unnest(range(1, 41))::INTEGER AS bin) b
CROSS JOIN (SELECT min(delivery_delay)::DOUBLE AS lo, max(delivery_delay)::DOUBLE AS hi FROM train)
LEFT JOIN (
  SELECT (least(floor((delivery_delay - lo) / ((hi - lo) / 40e0)), 39) + 1)::INTEGER AS bin,
    count(*) AS orders
  FROM train,
    (SELECT min(delivery_delay)::DOUBLE AS lo, max(delivery_delay)::DOUBLE AS hi FROM train)
  GROUP BY 1) c ON b.bin = c.bin""".format(
    S.r("lo + (b.bin - 1) * ((hi - lo) / 40e0)", 6), S.r("lo + b.bin * ((hi - lo) / 40e0)", 6))))
def delay_histogram(spark, sf):
    return _rounded(report.histogram(stages.train(spark, sf)), ["low", "high"])


_COVERED = ["shipping_cost", "weight_kg", "distance_km", "promised_delivery_days",
            "actual_delivery_days"]


@query("a21_coverage", S.with_(S.MAPPED, "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {S.r(f'100 * count({c}) / count(*)', 1)} AS populated_pct"
    f" FROM mapped" for c in _COVERED)))
def coverage(spark, sf):
    return report.coverage(stages.mapped(spark, sf), _COVERED)


@query("a22_test_share", S.with_(S.SPLIT, f"""
SELECT {S.r("count(*) FILTER (split = 'test') / count(*)", 4)} AS test_share FROM marked"""))
def test_share(spark, sf):
    return split.test_share_of(stages.marked(spark, sf))


def _section(name: str, label: str, value: str, group: str = "", where: str = "") -> str:
    return (f"SELECT '{name}' AS section, {label} AS label, ({value})::DOUBLE AS value"
            f" FROM featured {where} {group}")


_SUMMARY = "\nUNION ALL ".join([
    _section("size", "'total_rows'", "count(*)"),
    "SELECT 'size', 'train_rows', count(*)::DOUBLE FROM train",
    "SELECT 'size', 'test_rows', count(*)::DOUBLE FROM test",
    f"SELECT 'size', 'n_features', {len(SPLIT_FEATURES)}::DOUBLE",
    _section("delivery_delay_stats", "'mean'", S.r("avg(delivery_delay)", 3)),
    _section("delivery_delay_stats", "'median'", "median(delivery_delay)"),
    _section("delivery_delay_stats", "'std'", S.r("stddev_samp(delivery_delay)", 3)),
    _section("delivery_delay_stats", "'min'", "min(delivery_delay)"),
    _section("delivery_delay_stats", "'max'", "max(delivery_delay)"),
    _section("class_balance_is_delayed", "is_delayed::VARCHAR",
             S.r("count(*) / (SELECT count(*) FROM featured)", 4), "GROUP BY is_delayed"),
    _section("carrier_on_time_rate", "carrier", S.r("1 - avg(is_delayed)", 4),
             "GROUP BY carrier"),
    _section("orders_by_region", "destination_region", "count(*)", "GROUP BY destination_region"),
    _section("orders_by_category", "product_category", "count(*)", "GROUP BY product_category"),
    _section("avg_delay_by_distance_category", "distance_category",
             S.r("avg(delivery_delay)", 3), "GROUP BY distance_category",
             "WHERE distance_category IS NOT NULL"),
    _section("monthly_order_volume", "strftime(order_date, '%Y-%m')", "count(order_id)",
             "GROUP BY strftime(order_date, '%Y-%m')"),
])


@query("a23_summary", S.with_(S.SPLIT, _SUMMARY))
def summary(spark, sf):
    return report.summary_rows(stages.summarised(spark, sf))


@query("a23_summary_documents", S.with_(S.SPLIT, f"""
SELECT *, '{",".join(SPLIT_TARGETS)}' AS targets FROM ({_SUMMARY})"""))
def summary_documents(spark, sf):
    documents = report.summary_documents(report.summary_rows(stages.summarised(spark, sf)))
    return explode_rates(documents.drop("label"), "document", "label", "value",
                         keep=("section", "targets"))


# --- split --------------------------------------------------------------------


@query("m01_stable_fraction", _featured("""
SELECT order_id, (('0x' || substr(md5(order_id), 1, 8))::BIGINT % 10000) / 10000e0 AS fraction
FROM featured"""))
def fraction(spark, sf):
    return stages.featured(spark, sf).select("order_id",
                                             stable_fraction("order_id").alias("fraction"))


@query("m02_train_test", S.with_(S.SPLIT, "SELECT order_id, split FROM marked"))
def train_test(spark, sf):
    train, test = split.train_test(split.modelling_table(stages.featured(spark, sf)))
    return (train.select("order_id", F.lit("train").alias("split"))
            .unionByName(test.select("order_id", F.lit("test").alias("split"))))


@query("m03_modelling_table", S.with_(S.SPLIT, f"""
SELECT * REPLACE (strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date)
FROM (SELECT {S.columns(_MODEL)} FROM marked)"""))
def modelling_table(spark, sf):
    return split.modelling_table(stages.featured(spark, sf))


@query("u03_split_overlap", S.with_(S.SPLIT, """
SELECT count(*) AS overlap FROM (SELECT order_id FROM train INTERSECT SELECT order_id FROM test)"""))
def split_overlap(spark, sf):
    train, test = split.train_test(split.modelling_table(stages.featured(spark, sf)))
    return split.overlap(train, test).agg(F.count("*").alias("overlap"))


@query("j11_balance_side_by_side", S.with_(S.SPLIT, f"""
SELECT coalesce(a.is_delayed, b.is_delayed) AS is_delayed, a.share AS train, b.share AS test
FROM (SELECT is_delayed, {S.r('count(*) / (SELECT count(*) FROM train)', 4)} AS share FROM train
      GROUP BY 1) a
FULL JOIN (SELECT is_delayed, {S.r('count(*) / (SELECT count(*) FROM test)', 4)} AS share FROM test
      GROUP BY 1) b ON a.is_delayed = b.is_delayed"""))
def balance_side_by_side(spark, sf):
    return split.class_balance_by_split(stages.marked(spark, sf))
