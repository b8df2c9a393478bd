"""Stage semantics on small hand-made frames: missing values, edges, ties, degenerate groups."""

import json
import math
import statistics
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmetrics.functions.dates import date_formats, parse_timestamp, whole_days
from haulmetrics.functions.hashing import stable_fraction, uniform
from haulmetrics.functions.numeric import binned, haversine_km, ratio, round_even, to_number
from haulmetrics.functions.text import strip
from haulmetrics.operators.attach import attach
from haulmetrics.plans import (analytics, clean, features, marketplace, quality, report,
                               split)
from haulmetrics.plans.totals import group_totals, mean
from haulmetrics.schema import (DISTANCE_BINS, FEATURE_COLUMNS, LABEL_COLUMNS, ORDER_COLUMNS,
                                SIZE_BINS)
from haulmetrics.session import stage

TEXT = {*LABEL_COLUMNS, "order_date", "source_system"}
RAW_SCHEMA = T.StructType([
    T.StructField(c, T.StringType() if c in TEXT else T.DoubleType())
    for c in [*ORDER_COLUMNS, "source_system"]])

BASE = dict(
    order_id="ORD-1", order_date="2024-03-05", customer_id="C", customer_segment="S",
    product_id="P", product_category="toys", quantity=2.0, unit_price=10.0, discount_rate=0.0,
    weight_kg=1.0, origin_warehouse_id="WH-001", origin_region="R", destination_city="c",
    destination_country="c", destination_region="r", destination_latitude=1.0,
    destination_longitude=2.0, distance_km=100.0, carrier="A", shipping_mode="First Class",
    promised_delivery_days=3.0, actual_delivery_days=4.0, shipping_cost=8.0,
    order_status="open", delay_reason="None", source_system="dataco")


def raw(spark, *changes):
    rows = [{**BASE, "order_id": f"ORD-{i}", **change} for i, change in enumerate(changes, 1)]
    return stage(spark.createDataFrame([tuple(r[f.name] for f in RAW_SCHEMA) for r in rows],
                                       RAW_SCHEMA), "raw")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def by_id(df, *columns):
    return {r["order_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.collect()}


# --- expressions ------------------------------------------------------------

@pytest.mark.parametrize("value,digits,want", [(0.125, 2, 0.12), (2.5, 0, 2.0), (3.5, 0, 4.0),
                                               (1.015, 2, 1.01), (-0.001, 2, 0.0), (-2.5, 0, -2.0)])
def test_round_even(spark, value, digits, want):
    got = one(spark, round_even(F.lit(value), digits))
    assert got == want and math.copysign(1, got) == math.copysign(1, want)


@pytest.mark.parametrize("text,want", [("12", 12.0), ("x", None), ("NaN", None), ("", None)])
def test_to_number(spark, text, want):
    assert one(spark, to_number(F.lit(text))) == want


def test_ratio_by_zero_is_null(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0))) is None


def test_strip_takes_tabs_and_newlines(spark):
    assert one(spark, strip(F.lit("\t a b\n "))) == "a b"


@pytest.mark.parametrize("start,end,want", [
    ("2024-01-01 23:00:00", "2024-01-02 01:00:00", 0),
    ("2024-01-02 01:00:00", "2024-01-01 23:00:00", -1),
    ("2024-01-01 00:00:00", "2024-01-03 00:00:00", 2)])
def test_whole_days_floors(spark, start, end, want):
    assert one(spark, whole_days(F.lit(start).cast("timestamp"),
                                 F.lit(end).cast("timestamp"))) == want


@pytest.mark.parametrize("text,want", [
    ("2025-13-45", None), ("2024-02-03", datetime(2024, 2, 3)),
    ("1/31/2018 22:56", datetime(2018, 1, 31, 22, 56)), ("not a date", None)])
def test_parse_timestamp(spark, text, want):
    assert one(spark, parse_timestamp(F.lit(text))) == want


@pytest.mark.parametrize("km,want", [(0, "Local"), (500, "Local"), (500.01, "Regional"),
                                     (2000, "Regional"), (6000, "Long-Haul"),
                                     (6000.5, "International"), (-1, None), (None, None)])
def test_distance_edges(spark, km, want):
    assert one(spark, binned(F.lit(km).cast("double"), DISTANCE_BINS, low=0)) == want


@pytest.mark.parametrize("kg,want", [(0, "Small"), (5, "Small"), (25, "Medium"), (100, "Large"),
                                     (101, "Bulk")])
def test_size_edges(spark, kg, want):
    assert one(spark, binned(F.lit(kg).cast("double"), SIZE_BINS, low=0)) == want


def test_haversine_quarter_circle(spark):
    got = one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert got == pytest.approx(6371.0 * math.pi / 2)


# --- cleaning ----------------------------------------------------------------

def test_clean_counts_and_invariant(spark):
    copy = dict(order_id="ORD-1")
    df = raw(spark, {}, copy, dict(order_date="2025-13-45", shipping_mode=None),
             dict(destination_latitude=None), dict(destination_latitude=95.0),
             dict(destination_longitude=float("nan")), dict(shipping_mode=None),
             dict(actual_delivery_days=None), dict(shipping_cost=None, distance_km=None),
             dict(weight_kg=float("nan")))
    row = clean.clean_report(df).first().asDict()
    assert row == dict(
        input_rows=10, duplicates_removed=1, invalid_dates_dropped=1,
        missing_shipping_mode_before=1, invalid_coordinates_removed=3,
        missing_actual_delivery_days_before=1, missing_shipping_cost_before=1,
        missing_distance_km_before=1, missing_weight_kg_before=1, output_rows=5,
        rows_dropped_total=5)
    assert row["input_rows"] == row["output_rows"] + row["duplicates_removed"] \
        + row["invalid_dates_dropped"] + row["invalid_coordinates_removed"]
    assert clean.clean_orders(df).count() == row["output_rows"]


def test_clean_text_and_mode(spark):
    df = raw(spark, dict(product_category="\t tOYS \n", carrier=" A\t", order_status=" open "),
             dict(product_category=None),
             *[dict(shipping_mode=None, promised_delivery_days=d)
               for d in (0.0, 2.0, 5.0, 5.5, None)])
    out = by_id(clean.clean_orders(df), "product_category", "carrier", "order_status",
                "shipping_mode")
    assert out["ORD-1"] == ("Toys", "A", "OPEN", "First Class")
    assert out["ORD-2"][0] == "Unknown"
    assert [out[f"ORD-{i}"][3] for i in range(3, 8)] == [
        "Same Day", "First Class", "Second Class", "Standard Class", "Standard Class"]


def test_clean_is_stable_on_its_own_output(spark):
    df = raw(spark, {}, dict(quantity=5.0), dict(actual_delivery_days=None))
    once = stage(clean.clean_orders(df), "once")
    assert clean.clean_report(once).first()["rows_dropped_total"] == 0


def test_types_truncate_and_round(spark):
    df = raw(spark, dict(quantity=2.9, promised_delivery_days=3.9, actual_delivery_days=2.5,
                         unit_price=1.015, shipping_cost=0.125))
    row = clean.clean_orders(df).first()
    assert (row["quantity"], row["promised_delivery_days"], row["actual_delivery_days"]) == (2, 3, 2)
    assert (row["unit_price"], row["shipping_cost"]) == (1.01, 0.12)


def test_events_cleaned(spark):
    rows = [("o", "c", "2024-01-01 10:00:00", " delayed\t", "l", "None")] * 2 \
        + [("o", "c", "2025-13-45", "x", "l", "None")]
    df = spark.createDataFrame(rows, "order_id string, carrier string, event_timestamp string,"
                                     " event_type string, location string, delay_reason string")
    assert [tuple(r) for r in clean.clean_events(df).select("event_type").collect()] == [
        ("DELAYED",)]


# --- features ------------------------------------------------------------------

def featured(spark, *changes):
    return features.engineer_features(stage(clean.clean_orders(raw(spark, *changes)), "clean"))


def test_degenerate_groups_get_half(spark):
    out = by_id(featured(
        spark, dict(destination_region="flat"), dict(destination_region="flat"),
        dict(destination_region="still", actual_delivery_days=0.0),
        dict(destination_region="mixed", distance_km=10.0),
        dict(destination_region="mixed", distance_km=90.0),
        dict(destination_region="mixed", actual_delivery_days=0.0),
        dict(destination_region=None)), "route_efficiency_score")
    assert [out[f"ORD-{i}"] for i in range(1, 8)] == [0.5, 0.5, 0.5, 0.0, 1.0, None, None]


def test_missing_carrier_has_no_scores(spark):
    out = by_id(featured(spark, {}, dict(carrier=None)),
                "carrier_performance_score", "reorder_risk_score", "inventory_turnover",
                "seasonal_demand_index")
    assert out["ORD-2"][:2] == (None, None) and None not in out["ORD-2"][2:]
    assert None not in out["ORD-1"]


def test_zero_quantity_gets_the_median_cost(spark):
    out = by_id(featured(spark, dict(quantity=0.0), dict(shipping_cost=3.0),
                         dict(shipping_cost=5.0), dict(shipping_cost=9.0)),
                "shipping_cost_per_unit")
    assert out["ORD-1"] == 2.5


def test_utilisation_uses_capacity_else_peak_else_null(spark):
    out = by_id(featured(
        spark, dict(quantity=420.0), dict(origin_warehouse_id="X", quantity=3.0),
        dict(origin_warehouse_id="X", quantity=1.0, order_date="2024-03-06"),
        dict(origin_warehouse_id="Y", quantity=0.0)), "warehouse_utilization")
    assert [out[f"ORD-{i}"] for i in range(1, 5)] == [0.1, 1.0, 0.3333, None]


def test_features_against_plain_python(spark):
    changes = [dict(order_date=f"2024-0{m}-0{d}", carrier=c, product_category=k,
                    quantity=float(q), actual_delivery_days=float(a))
               for m, d, c, k, q, a in [(1, 1, "A", "x", 2, 1), (1, 1, "A", "x", 4, 9),
                                        (2, 2, "A", "y", 6, 9), (2, 3, "B", "y", 1, 2),
                                        (2, 3, "B", "x", 5, 9), (3, 1, "B", "z", 7, 3)]]
    out = by_id(featured(spark, *changes), "is_delayed", "seasonal_demand_index",
                "inventory_turnover", "reorder_risk_score", "carrier_performance_score")
    rows = [{**BASE, **c} for c in changes]
    late = [int(r["actual_delivery_days"] > r["promised_delivery_days"]) for r in rows]
    months = [r["order_date"][:7] for r in rows]
    index = [round(months.count(m) / (len(rows) / 3), 4) for m in months]
    cats = [r["product_category"] for r in rows]
    vol = {k: statistics.stdev(v) if len(v) > 1 else 0.0 for k in set(cats)
           for v in [[x for x, c in zip(index, cats) if c == k]]}
    low, high = min(vol.values()), max(vol.values())
    for i, r in enumerate(rows):
        same = lambda *cols: [j for j, o in enumerate(rows) if all(o[c] == r[c] for c in cols)]
        pair = same("carrier", "product_category")
        risk = 0.65 * statistics.mean(late[j] for j in pair) \
            + 0.35 * (vol[cats[i]] - low) / (high - low + 1e-9)
        day = same("product_category", "order_date")
        units = sum(rows[j]["quantity"] for j in day)
        mean = statistics.mean(rows[j]["quantity"] for j in same("product_category"))
        score = 1 - statistics.mean(late[j] for j in same("carrier"))
        want = (late[i], index[i], units / (mean * 30), risk, score)
        assert out[f"ORD-{i + 1}"] == pytest.approx(want, abs=6e-5)


def test_feature_columns_and_order(spark):
    assert featured(spark, {}).columns == [*ORDER_COLUMNS, "source_system", *FEATURE_COLUMNS]


# --- quality ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def good_rows(spark):
    return stage(featured(spark, {}, dict(promised_delivery_days=9.0),
                          dict(source_system="olist", promised_delivery_days=9.0)), "good")


BREAKS = {
    "order_id:unique": ("order_id", "'ORD-1'"),
    "order_id:not_null": ("order_id", "cast(null as string)"),
    "order_date:not_null": ("order_date", "cast(null as timestamp)"),
    "carrier:not_null": ("carrier", "cast(null as string)"),
    "source_system:in_set": ("source_system", "'elsewhere'"),
    "shipping_mode:in_set": ("shipping_mode", "'Teleport'"),
    "quantity:between": ("quantity", "0"),
    "unit_price:between": ("unit_price", "10000.5"),
    "shipping_cost:between": ("shipping_cost", "-0.5"),
    "destination_latitude:between": ("destination_latitude", "90.5"),
    "destination_longitude:between": ("destination_longitude", "-180.5"),
    "distance_km:between": ("distance_km", "25000.5"),
    "promised_delivery_days:between": ("promised_delivery_days", "181"),
    "actual_delivery_days:between": ("actual_delivery_days", "241"),
    "order_id:matches": ("order_id", "'ORD-12x'"),
    "carrier_performance_score:between": ("carrier_performance_score", "1.5"),
    "route_efficiency_score:between": ("route_efficiency_score", "-0.5"),
    "reorder_risk_score:between": ("reorder_risk_score", "1.01"),
    "distance_category:in_set": ("distance_category", "'nan'"),
    "shipment_size_category:in_set": ("shipment_size_category", "'Huge'"),
    "is_delayed:mean_between": ("is_delayed", "1"),
}


def test_all_rules_pass_on_good_rows(good_rows):
    df = good_rows
    row = quality.report(quality.validate(df), len(df.columns)).first()
    assert (row["total_expectations"], row["passed"], row["success_rate_pct"],
            row["overall_success"], row["dataset_rows"], row["dataset_columns"]) == (
        21, 21, 100.0, True, 3, 37)
    assert row["failed_expectations"] == "[]"


def test_every_rule_is_covered():
    assert set(BREAKS) == {rule.name for rule in quality.ORDER_SUITE}
    assert quality.suite_from_json(quality.suite_to_json(quality.ORDER_SUITE)) \
        == quality.ORDER_SUITE


@pytest.mark.parametrize("name", BREAKS)
def test_each_rule_finds_its_violation(good_rows, name):
    column, bad = BREAKS[name][0], F.expr(BREAKS[name][1])
    everywhere = name == "is_delayed:mean_between"
    hit = F.lit(True) if everywhere else F.col("order_id") == "ORD-2"
    df = good_rows.withColumn(column, F.when(hit, bad).otherwise(F.col(column)))
    failed = {r["rule"]: r["unexpected_count"]
              for r in quality.validate(df).where("not success").collect()}
    assert list(failed) == [name]
    assert failed[name] == {"order_id:unique": 2, "is_delayed:mean_between": None}.get(name, 1)


def test_gates(good_rows):
    df = good_rows
    bad = df.withColumns({c: F.lit(-1) for c in ("quantity", "unit_price", "shipping_cost")})
    for frame, ok in ((df, True), (bad, False)):
        summary = quality.report(quality.validate(frame), 37)
        if ok:
            quality.require_pass_rate(summary)
        else:
            with pytest.raises(ValueError, match="85.71%"):
                quality.require_pass_rate(summary)


# --- split and report ----------------------------------------------------------------

@pytest.mark.parametrize("partitions", [1, 4, 50])
def test_split_ignores_partitioning(spark, partitions):
    import hashlib
    df = spark.range(2_000).select(F.format_string("ORD-%d", "id").alias("order_id"))
    got = {r["order_id"]: r["f"] for r in df.repartition(partitions).select(
        "order_id", stable_fraction("order_id").alias("f")).collect()}
    assert got == {k: int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 10_000 / 10_000.0
                   for k in got}
    marked = split.with_split(df)
    share = split.test_share_of(marked).first()[0]
    assert 0.17 < share < 0.23
    train, test = split.train_test(df)
    assert split.overlap(train, test).isEmpty() and train.count() + test.count() == 2_000


def test_balance_keeps_a_class_missing_on_one_side(spark):
    df = spark.createDataFrame([(0, "train"), (0, "test"), (1, "train"), (None, "test")],
                               "is_delayed int, split string")
    got = {r["is_delayed"]: (r["train"], r["test"])
           for r in split.class_balance_by_split(df).collect()}
    assert got == {0: (0.5, 1.0), 1: (0.5, None)}


def test_write_split_round_trip(spark, tmp_path):
    df = featured(spark, {}, dict(quantity=3.0), dict(quantity=4.0))
    stored = split.write_split(df, str(tmp_path))
    assert stored.count() == 3
    assert spark.read.option("header", True).csv(f"{tmp_path}/flat_csv").count() == 3


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(float(i),) for i in range(41)] + [(None,)],
                               "delivery_delay double")
    got = {r["bin"]: r["orders"] for r in report.histogram(df).collect()}
    assert got == {**{b: 1 for b in range(1, 40)}, 40: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "delivery_delay double")
    bins = sorted(tuple(r) for r in report.histogram(flat).collect())
    assert len(bins) == 40 and bins[20] == (21, 3.0, 3.025, 2)
    assert bins[0][1] == 2.5 and bins[-1][2] == 3.5 and sum(b[3] for b in bins) == 2
    assert report.histogram(flat.limit(0)).collect() == []


def test_late_events_by_type_or_reason(spark):
    rows = [("a", "DELIVERED", "Late delivery"), ("a", "DELIVERED", None), ("b", "SHIPPED", "LATE"),
            ("c", "SHIPPED", "None")]
    df = spark.createDataFrame(rows, "carrier string, event_type string, delay_reason string")
    rate = lambda d: {r["carrier"]: r["on_time_rate"]
                      for r in report.carrier_event_rate(d).collect()}
    assert rate(df) == {"a": 0.5, "b": 0.0, "c": 1.0}
    delayed = spark.createDataFrame([("c", "DELAYED", "None")], df.schema)
    assert rate(df.union(delayed)) == {"a": 1.0, "b": 1.0, "c": 0.5}


def test_summary_documents(spark):
    rows = report.summary_rows(stage(featured(spark, {}, dict(carrier="B")), "f"))
    docs = report.summary_documents(rows).collect()
    assert len(docs) == rows.count()
    rates = {r["document"] for r in docs if r["section"] == "carrier_on_time_rate"}
    assert rates == {'{"A":0.0}', '{"B":0.0}'}
    assert '{"total_rows":2.0}' in {r["document"] for r in docs if r["section"] == "size"}


def test_summary_of_no_rows(spark):
    rows = report.summary_rows(stage(featured(spark, {}).limit(0), "f"))
    found = {(r["section"], r["label"]): r["value"] for r in rows.collect()}
    assert found["size", "total_rows"] == 0 and found["size", "n_features"] > 0


def test_sample_size_and_threshold_path(spark):
    df = spark.range(9_000).withColumn("id", F.col("id").cast("string"))
    small = sorted(r[0] for r in report.hash_sample(df, "id", 50).collect())
    draw = uniform("id", "sample", 42)
    assert small == sorted(r[0] for r in df.orderBy(draw, "id").limit(50).collect())
    assert report.hash_sample(df, "id", 10_000).count() == 9_000


def test_positions_follow_the_order(spark):
    df = spark.range(50).repartition(5).orderBy(F.col("id").desc())
    assert all(r["position"] == 50 - r["id"] for r in report.with_position(df).collect())


def test_group_totals_match_plain_groups(spark):
    rows = [("a", "x", 1, 2.0), ("a", "y", 0, None), (None, "x", None, 4.0), ("b", None, 1, -1.0)]
    df = spark.createDataFrame(rows, "carrier string, region string, is_delayed int, d double") \
        .withColumn("order_id", F.lit("o"))
    totals = group_totals(df, [["carrier", "region"], ["region"], ["carrier"]], ["is_delayed", "d"])
    for keys in (["carrier", "region"], ["region"], ["carrier"]):
        got = totals.by(*keys).select(*keys, "rows", mean("is_delayed"), mean("d"))
        want = df.groupBy(*keys).agg(F.count("*"), F.avg("is_delayed"), F.avg("d"))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_cleaning_shuffles_whole_rows_once(spark):
    """Duplicates, counters and the table come from one exchange of all columns."""
    rows = clean.folded(raw(spark, {}, {}))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    table, report_ = clean.clean_with_report(raw(spark, {}, {}, dict(order_date="bad")))
    assert (table.count(), report_.first()["input_rows"]) == (2, 3)


def test_values_beyond_32_bits(spark):
    row = clean.clean_orders(raw(spark, dict(quantity=3e9, promised_delivery_days=4e9))).first()
    assert (row["quantity"], row["promised_delivery_days"]) == (3_000_000_000, 4_000_000_000)


@pytest.mark.parametrize("text", ["12D", "5f", "0x1p3", "1_000", "", "abc", "1e", "NaN"])
def test_text_that_is_no_number(spark, text):
    assert one(spark, to_number(F.lit(text))) is None


@pytest.mark.parametrize("text,want", [
    ("1/31/2018 22:56:30", "2018-01-31 22:56:30"), ("2018/01/31 10:00", "2018-01-31 10:00:00"),
    ("20180131", "2018-01-31 00:00:00"), ("31-01-2018", "2018-01-31 00:00:00"),
    ("12:30", None), ("T12:30", None), ("2025-13-45", None)])
def test_more_dates(spark, text, want):
    got = one(spark, parse_timestamp(F.lit(text)))
    assert (got and str(got)) == want


def test_formats_of_a_feed(spark):
    df = raw(spark, dict(order_date="31|12|2024"))
    assert clean.clean_orders(df).count() == 0
    assert clean.clean_orders(df, formats=["d|M|yyyy"]).count() == 1


def test_report_lists_what_failed(spark):
    df = featured(spark, {}, dict(unit_price=20_000.0), dict(unit_price=-1.0))
    row = quality.report(quality.validate(df), len(df.columns)).first()
    failed = json.loads(row["failed_expectations"])
    assert (row["failed"], row["overall_success"]) == (len(failed), False)
    prices = [f for f in failed if f["column"] == "unit_price"]
    assert [(f["kind"], f["unexpected_count"]) for f in prices] == [("between", 2)]


def test_stored_expectation_suite(spark):
    text = quality.suite_to_expectations(quality.ORDER_SUITE)
    assert quality.suite_from_expectations(text) == quality.ORDER_SUITE
    one_rule = json.dumps({"expectations": [{
        "id": "x", "meta": {}, "severity": "warning", "type": "expect_column_values_to_be_between",
        "kwargs": {"column": "quantity", "min_value": 1, "max_value": 9}}]})
    assert quality.suite_from_expectations(one_rule) == [
        quality.Rule("between", "quantity", {"min": 1, "max": 9}, "warning")]


def test_features_do_not_depend_on_the_join_path(spark, monkeypatch):
    """Broadcast statistics, salted hot keys and shuffled cold keys give the same rows."""
    changes = [dict(order_date=f"2024-0{1 + i % 3}-0{1 + i % 5}", quantity=float(1 + i % 7),
                    carrier=[None, "A", "A", "A", "B"][i % 5], distance_km=10.0 * i,
                    product_category=["x", "y", None][i % 3], shipping_mode="First Class",
                    destination_region=["r", "r", "s", None][i % 4],
                    origin_warehouse_id=["WH-001", "X", "X", None][i % 4],
                    actual_delivery_days=None if i % 6 == 0 else float(i % 8))
               for i in range(60)]
    source = raw(spark, *changes)
    want = by_id(features.engineer_features(stage(clean.clean_orders(source), "clean")),
                 "actual_delivery_days", *FEATURE_COLUMNS)
    monkeypatch.setitem(attach.__kwdefaults__, "broadcast_rows", 0)
    monkeypatch.setitem(attach.__kwdefaults__, "hot_keys", 3)
    got = by_id(features.engineer_features(stage(clean.clean_orders(source, small_group=3,
                                                                    accuracy=20), "clean")),
                "actual_delivery_days", *FEATURE_COLUMNS)
    assert len(want) == 60 and got == want


def test_rolling_trend_does_not_depend_on_chunks(spark):
    df = stage(featured(spark, *[dict(order_date=f"2024-01-{1 + i % 9:02d}",
                                      carrier="AB"[i % 4 == 0],
                                      actual_delivery_days=float(i % 11)) for i in range(80)]), "f")
    name = "rolling_avg_delay_7orders"
    assert by_id(analytics.rolling_delay(df), name) \
        == by_id(analytics.rolling_delay(df, chunk_rows=5), name)


def test_formats_of_the_column_itself(spark):
    df = raw(spark, *[dict(order_date=d) for d in (
        "13/02/2024", "02/03/2024", "02-Jan-2024", "2024-05-06", "3 february 2024", "soon")])
    got = {r["order_id"]: str(r["order_date"])[:10]
           for r in clean.clean_orders(df, formats=None).collect()}
    assert got == {"ORD-1": "2024-02-13", "ORD-2": "2024-03-02", "ORD-3": "2024-01-02",
                   "ORD-4": "2024-05-06", "ORD-5": "2024-02-03"}


def test_report_of_date_formats(spark):
    def report(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        return {r["format"][:8]: (r["parsed"], r["chosen"], r["place"], r["fits_all"], r["ambiguous"])
                for r in date_formats(df, "t").collect()}

    assert report("02/03/2024", "01/01/2024", None) == {
        "M/d/yyyy": (2, 2, 1, True, True), "d/M/yyyy": (2, 0, 2, True, True)}
    assert report("02/03/2024", "31/01/2024") == {
        "d/M/yyyy": (2, 2, 1, True, False), "M/d/yyyy": (1, 0, 2, False, False)}
    assert report("01/01/2024") == {  # both forms read the same time
        "M/d/yyyy": (1, 1, 1, True, False), "d/M/yyyy": (1, 0, 2, True, False)}
    assert report("2024-02-03", "13.02.2024") == {
        "ISO": (1, 1, 1, False, False), "d.M.yyyy": (1, 1, 2, False, False)}
    assert report() == {} and report(None, "soon") == {}


def test_rejected_rows_keep_what_came(spark):
    bad = dict(order_date="soon", carrier=" x ")
    df = raw(spark, {}, bad, dict(destination_latitude=95.0), dict(destination_longitude=None))
    df = stage(df.union(df.where("order_id = 'ORD-2'")), "twice")
    cleaned, report, rejected = clean.clean_with_rejects(df)
    assert rejected.columns == ["step", "reason", "copies", *df.columns]
    got = {r["order_id"]: r for r in rejected.collect()}
    assert {k: (r["step"], r["copies"]) for k, r in got.items()} == {
        "ORD-2": ("dates", 2), "ORD-3": ("coordinates", 1), "ORD-4": ("coordinates", 1)}
    assert (got["ORD-2"]["order_date"], got["ORD-2"]["carrier"]) == ("soon", " x ")
    counts = report.first()
    assert (counts["invalid_dates_dropped"], counts["invalid_coordinates_removed"]) == (1, 2)
    assert [tuple(r) for r in cleaned.collect()] == [tuple(r) for r in clean.clean_orders(df).collect()]
    assert report.collect() == clean.clean_report(df).collect()


def test_strip_takes_every_unicode_blank(spark):
    for blank in map(chr, range(0x3001)):
        if blank.isspace():
            assert one(spark, strip(F.lit(f"{blank}a b{blank}"))) == "a b"


def test_whole_keys(spark):
    df = spark.createDataFrame([("c1", "p", "abcdefgh1"), ("c1", "p", "abcdefgh2"), ("c2", None, "x")],
                               "customer_id string, product_id string, seller_id string")
    got = {r["column"]: (r["length"], r["keys"], r["merged"]) for r in marketplace.merged_keys(
        df, {**marketplace.KEY_LENGTHS, "carrier": None}).collect()}
    assert got == {"customer_id": (12, 2, 0), "product_id": (12, 1, 0),
                   "origin_warehouse_id": (8, 3, 2), "carrier": (None, 3, 0)}
