"""Steps that must not send more rows than they need."""

import math
import time

from pyspark.sql import functions as F

from checks import fixture, registry, stages
from haulmetrics.functions.text import packed, unpacked
from haulmetrics.operators import impute, quantiles
from haulmetrics.operators.attach import attach, fits
from haulmetrics.operators.numbering import number_rows
from haulmetrics.plans import clean, mapping, marketplace, quality
from haulmetrics.session import stage
from haulmetrics.sources import csv, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shown(rows):
    return sorted(str([None if v is None else "nan" if v != v else str(v) for v in r])
                  for r in rows)


def test_copies_are_counted_and_single_rows_stay(spark):
    rows = ([("a", 1.0), ("a", 1.0), ("a", None), (None, None), (None, None), (None, None),
             ("z", 0.0), ("z", -0.0), ("y", -0.0), ("n", math.nan), ("n", math.nan)]
            + [(f"r{i}", float(i)) for i in range(50)])
    df = stage(spark.createDataFrame(rows, "k string, v double"), "t")
    want = shown(df.groupBy("k", "v").agg(F.count("*")).collect())
    for limits in ({}, {"write": False}, {"broadcast_rows": 0}):
        assert shown(clean.counted_rows(df, **limits).collect()) == want
    hashes = plan(clean.counted_rows(df)).count("Exchange hashpartitioning")
    assert hashes == 1  # rows of repeated hashes only


def test_rows_of_hot_keys_are_not_shuffled(spark):
    df = stage(spark.range(200).select((F.col("id") % 100).alias("k"), "id")
               .unionByName(spark.range(900).select(F.lit(0).cast("bigint").alias("k"), "id")), "t")
    stats = stage(df.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")), "s")
    got = attach(df, stats, ["k"], weight="n", broadcast_rows=0, hot_keys=10)
    top = {r["k"]: r["top"] for r in stats.collect()}
    found = got.collect()
    assert len(found) == 1100 and all(r["top"] == top[r["k"]] for r in found)
    assert "__salt" not in plan(got) and "SortMergeJoin" not in plan(got)


def test_numbers_take_one_shuffle_of_rows(spark):
    df = stage(spark.range(500).select((F.col("id") % 400).alias("a"),
                                       (F.col("id") % 400 * 2).alias("b")), "t")
    for block in (100_000, 1):
        rows = number_rows(df, ["a"], block=block).collect()
        assert sorted(r["row_number"] for r in rows) == list(range(1, 501))
        digests = [r["a"] for r in sorted(rows, key=lambda r: r["row_number"])]
        if block > 1:
            first = digests
    assert digests == first
    assert plan(number_rows(df, ["a"])).count("Exchange hashpartitioning") == 1


def test_smaller_segment_is_looked_up(spark, monkeypatch):
    seen = []

    def counted(df, stats, *args, **options):
        seen.append(stats.count())
        return attach(df, stats, *args, **options)

    monkeypatch.setattr(marketplace, "attach", counted)
    for rows, want in (
            ([("a",)] * 2 + [("b",)] * 3 + [(None,)] * 2 + [("c",)], {"c": "New"}),
            ([("a",), ("b",), (None,), ("d",), ("d",)], {"d": "Returning"})):
        df = stage(spark.createDataFrame(rows, "customer_unique_id string"), "t")
        rest = "Returning" if "New" in want.values() else "New"
        got = marketplace.buyer_segment(df).collect()
        assert len(got) == len(rows)
        assert all(r["customer_segment"] == want.get(r["customer_unique_id"], rest) for r in got)
    assert seen == [1, 1]


def test_few_values_of_a_large_group_are_counted(spark, monkeypatch):
    def never(*args):
        raise AssertionError("sketched")

    monkeypatch.setattr(quantiles, "_bracketed", never)
    df = stage(spark.range(1_001).select((F.col("id") % 3).cast("double").alias("v")), "t")
    assert quantiles.exact_median(df, "v", small_group=10) == 1.0


def test_types_ruled_out_by_first_rows_and_by_later_ones(spark, monkeypatch):
    monkeypatch.setattr(tables, "FIRST_ROWS", 2)
    rows = [("1", "1.5", "2020-01-01", "x", None, "7", None)] * 3 + [
        ("2", "3", "2020-02-01", "4", None, "late", "5")]
    df = stage(spark.createDataFrame(rows, "a string, b string, c string, d string, e string, "
                                           "f string, g string").coalesce(1), "t")
    got = {r["column"]: (r["type"], r["known"]) for r in tables.describe_columns(df).collect()}
    assert got == {"a": ("integer", 4), "b": ("number", 4), "c": ("timestamp", 4),
                   "d": ("text", 4), "e": ("text", 0), "f": ("text", 4), "g": ("integer", 1)}


def test_numbers_need_no_column_that_is_not_used(spark):
    df = stage(spark.range(50).select((F.col("id") % 7).alias("a"), (F.col("id") % 14).alias("b"),
                                      F.col("id").cast("string").alias("wide")), "t")
    numbered = number_rows(df, ["a"], keep=[(F.col("b") + 1).alias("c"), F.col("wide")])
    assert numbered.columns == ["c", "wide", "row_number"]
    sorts = [line for line in plan(numbered.select("c", "row_number")).splitlines()
             if "Sort [" in line or "Window [" in line]
    assert sorts and not [line for line in sorts if "wide" in line]
    want = sorted(tuple(r) for r in numbered.collect())
    assert sorted(r[2] for r in want) == list(range(1, 51))
    # rows equal in the key get the same numbers however they lie, and without folding
    for block in (100_000, 1):
        again = number_rows(df.repartition(3), ["a"], block=block,
                            keep=[(F.col("b") + 1).alias("c"), F.col("wide")])
        assert sorted(tuple(r) for r in again.collect()) == want


def test_keys_are_shuffled_as_bytes_and_come_back(spark):
    keys = ["ab" * 16, "AB" * 16, "abc", "", "\x01ab", "key \u00e9", "00", "0", "zz", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k", packed("k").alias("p"))
    rows = df.select("k", unpacked("p").alias("u"), F.length("p").alias("n")).collect()
    assert [r["u"] for r in rows] == keys and rows[0]["n"] == 17

    def made(columns, *values):
        return stage(spark.createDataFrame(list(values), columns), "t")

    first = "ab" * 16
    joined = marketplace.join_tables({
        "items": made("order_id string, order_item_id int, product_id string, seller_id string",
                      (first, 1, "p", "00"), (first, 2, None, "S"), ("none", 1, "p", "00"),
                      (None, 1, "p", "00")),
        "orders": made("order_id string, customer_id string", (first, "c1"), (None, "c1")),
        "customers": made("customer_id string, customer_unique_id string, "
                          "customer_zip_code_prefix string", ("c1", "AB", "1")),
        "products": made("product_id string, product_category_name string", ("p", "x")),
        "translation": made("product_category_name string, product_category_name_english string",
                            ("x", "y")),
        "sellers": made("seller_id string, seller_zip_code_prefix string", ("00", "1")),
        "geolocation": made("geolocation_zip_code_prefix string, geolocation_lat double, "
                            "geolocation_lng double", ("1", 2.0, 3.0))})
    got = sorted((r["order_id"], r["order_item_id"], r["product_id"] or "", r["seller_id"],
                  r["customer_unique_id"], r["product_category_name_english"],
                  r["geolocation_lat_sell"]) for r in joined.collect())
    assert got == [(first, 1, "p", "00", "AB", "y", 2.0), (first, 2, "", "S", "AB", None, None)]
    assert {kind for name, kind in joined.dtypes if name in marketplace.KEYS} == {"string"}
    assert "unhex" in plan(joined)


def test_rows_with_a_value_are_not_looked_up(spark, monkeypatch):
    seen = []

    def counted(df, *args, **options):
        seen.append(df.where("__group is not null").count())
        return attach(df, *args, **options)

    monkeypatch.setattr(impute, "attach", counted)
    df = stage(spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)],
                                     "g string, v double"), "t")
    got = impute.fill_from_groups(df, [("v", ["g"])])
    assert sorted((r["g"], r["v"]) for r in got.collect()) == [
        ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 5.0)]
    assert seen == [1]


def test_narrow_statistics_are_broadcast_by_their_bytes(spark):
    df = stage(spark.range(900).select((F.col("id") % 300).alias("k"), "id"), "t")
    stats = stage(df.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")), "s")
    near = attach(df, stats, ["k"], weight="n", broadcast_rows=10)
    assert "Exchange hashpartitioning" not in plan(near)
    far = attach(df, stats, ["k"], weight="n", broadcast_rows=10, broadcast_bytes=1_000, hot_keys=2)
    assert "Exchange hashpartitioning" in plan(far)
    wide = stage(stats.withColumn("all", F.array("top")), "s")
    assert "Exchange hashpartitioning" in plan(attach(df, wide, ["k"], weight="n",
                                                      broadcast_rows=10, hot_keys=2))
    rows = sorted((r["id"], r["top"]) for r in near.collect())
    assert rows == sorted((r["id"], r["top"]) for r in far.collect())
    assert rows == [(i, 600 + i % 300) for i in range(900)]


def test_small_tables_join_after_the_orders(spark, monkeypatch):
    def made(columns, *values):
        return stage(spark.createDataFrame(list(values), columns), "t")

    tables = {
        "items": made("order_id string, order_item_id int, product_id string, seller_id string",
                      ("o", 1, "p", "s"), ("o", 2, "q", "s"), ("o", 3, None, None), ("x", 1, "p", "s")),
        "orders": made("order_id string, customer_id string", ("o", "c"), ("n", "c")),
        "customers": made("customer_id string, customer_zip_code_prefix string", ("c", "1")),
        "products": made("product_id string, product_category_name string",
                         ("p", "x"), ("q", None), ("q", "z"), (None, "x")),
        "translation": made("product_category_name string, product_category_name_english string",
                            ("x", "y"), ("x", "Y"), (None, "none")),
        "sellers": made("seller_id string, seller_zip_code_prefix string", ("s", "1")),
        "geolocation": made("geolocation_zip_code_prefix string, geolocation_lat double, "
                            "geolocation_lng double", ("1", 2.0, 3.0))}
    name = "spark.sql.autoBroadcastJoinThreshold"
    value = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        near = marketplace.join_tables(tables)
        moved = [line for line in plan(near).splitlines() if "Exchange hashpartitioning" in line]
        assert not [line for line in moved if "product_id" in line or "seller_id" in line]
        monkeypatch.setattr(marketplace, "fits", lambda table: False)
        far = marketplace.join_tables(tables)
        assert "hashpartitioning(product_id" in plan(far)
    finally:
        spark.conf.set(name, value)
    assert near.columns == far.columns
    assert shown(near.collect()) == shown(far.collect()) and near.count() == 5


def test_bytes_decide_whether_a_table_fits(spark):
    df = stage(spark.createDataFrame([("a" * 100, 1), (None, 2)], "k string, n int"), "t")
    assert fits(df, 2 * (48 + 16) + 100) and not fits(df, 2 * (48 + 16) + 99)
    assert fits(df.where("n > 2"), 0) and not fits(df.select(F.array("k")), 10_000)


def test_merged_keys_are_taken_in_one_pass_of_the_keys(spark, monkeypatch):
    staged = []

    def seen(df, name):
        staged.append(plan(df))
        return stage(df, name)

    monkeypatch.setattr(marketplace, "stage", seen)
    df = stage(spark.createDataFrame(
        [("a" * 12 + "1", "P", "s1", "w"), ("a" * 12 + "2", "P", "s2", "w"), (None, None, None, "w"),
         ("a" * 12 + "1", "p", "", "w")],
        "customer_id string, product_id string, seller_id string, wide string"), "t")
    got = {r["column"]: (r["length"], r["keys"], r["merged"])
           for r in marketplace.merged_keys(df).collect()}
    assert got == {"customer_id": (12, 2, 2), "product_id": (12, 2, 0),
                   "origin_warehouse_id": (8, 3, 0), "carrier": (6, 3, 0)}
    assert len(staged) == 1 and staged[0].count("FileScan") == 1 and "wide" not in staged[0]


def test_queries_store_no_more_than_they_read(spark, monkeypatch):
    from checks import queries_analytics, queries_feeds, stages
    from haulmetrics.plans.report import SUMMARY_COLUMNS

    def never(*args):
        raise AssertionError("stored whole")

    sf = "/root/testdata/sf0.001"
    for name in ("featured", "joined"):
        monkeypatch.setattr(stages, name, never)
    assert {p.rsplit("/", 2)[1].split("-")[0] for p in stages.clean(spark, sf).inputFiles()
            if "/quantiles-" not in p} == {"located"}
    assert stages.summarised(spark, sf).columns == list(SUMMARY_COLUMNS)
    assert queries_analytics.summary(spark, sf).count() > 0
    assert len(queries_analytics.first_rows(spark, sf).collect()) == 5
    assert queries_feeds.merged_keys(spark, sf).count() == 4


def test_lines_are_shuffled_without_the_suppliers(spark):
    from checks import fixture

    rows = fixture.star(spark, "/root/testdata/sf0.001")
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
             if "Join Inner" in line]
    assert "l_suppkey" in joins[0] and "l_orderkey" in joins[1]


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_shuffle_files_go_when_a_stage_is_written(spark):
    before = shuffle_files(spark)
    df = spark.range(1_000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    stage(df.orderBy("n", "k"), "t")
    for _ in range(50):  # they are removed beside the next step
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    rows = df.orderBy("k")
    assert rows.collect() == rows.collect()  # a plan that runs again makes its files again


def test_copies_are_dropped_by_hash(spark):
    rows = ([("a", 1.0), ("a", 1.0), (None, None), (None, None), ("z", 0.0), ("z", -0.0),
             ("y", -0.0), ("n", math.nan), ("n", math.nan)] + [(f"r{i}", 1.0) for i in range(50)])
    df = stage(spark.createDataFrame(rows, "k string, v double"), "t")
    got = clean.drop_copies(df)
    assert shown(got.collect()) == shown(df.dropDuplicates().collect())
    # what travels are the rows of repeated hashes, as the join before the exchange tells
    exchange = plan(clean.drop_copies(df)).split("Exchange hashpartitioning")
    assert len(exchange) == 2 and "LeftSemi" in exchange[1]


def test_repeated_values_are_found_by_hash(spark):
    rows = [("a",), ("a",), ("a",), ("b",), ("c",), ("c",), (None,), (None,)]
    df = stage(spark.createDataFrame(rows, "k string"), "t")
    found = quality.repeated_rows(df, "k")
    assert found.first()["repeated"] == 5
    assert "LeftSemi" in plan(found)
    assert quality.repeated_rows(df.where("k = 'b' or k is null"), "k").first()["repeated"] == 0


def test_ids_are_compared_by_hash(spark):
    for ids, numbered in ((["1", "2"], False), (["1", "1"], True), (["1", None], True),
                          ([None, None], True), (["1", None, None], True), (["A", "2"], True)):
        df = spark.createDataFrame([(i,) for i in ids], "order_id string")
        assert mapping.id_expression(df)[1] == numbered
    df = spark.createDataFrame([("1",), (None,)], "order_id string")
    made = df.withColumn("row_number", F.lit(7)).select(mapping.id_expression(df)[0]).collect()
    assert [r[0] for r in made] == ["ORD-1", "ORD-7"]  # one missing id repeats nothing


def test_compressed_csv_is_cut_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PACKED_ROWS", 30)
    rows = [(f" a\n{i}", 'x "q", y' if i % 2 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    tables.write_csv(df, str(tmp_path / "c"), compression="gzip")
    assert len(list((tmp_path / "c").glob("*.csv.gz"))) == 4
    got = csv.read_csv(spark, str(tmp_path / "c"), ["a", "b"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)


def test_lines_are_not_shuffled_for_suppliers(spark):
    """One exchange of the lines by part and one by order at most; none by supplier or nation."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        text = plan(fixture.star(spark, SF))
    finally:
        spark.conf.set(limit, old)
    assert "hashpartitioning(l_partkey" in text and "hashpartitioning(l_orderkey" in text
    assert "hashpartitioning(l_suppkey" not in text and "nationkey" not in "".join(
        part.split(")")[0] for part in text.split("hashpartitioning(")[1:])


def test_queries_store_what_they_read(spark, monkeypatch):
    """Neither the whole featured orders nor the whole join, nor the mapped feed."""
    stored = {}

    def noted(df, name):
        stored.setdefault(name, []).append(df.columns)
        return stage(df, name)

    monkeypatch.setattr(stages, "stage", noted)
    stages.forget()
    registry.load()
    queries = registry.QUERIES
    for name in ("a08_delay_by_distance", "a16_carrier_exploration", "p08_formula_fill",
                 "p18_great_circle"):
        queries[name](spark, SF)
    assert not {"orders_featured", "vendor_mapped_unique", "market_joined"} & set(stored)
    for name in ("q01_unique", "q10_pass_rate_gate", "s14_analytics_sink"):
        queries[name](spark, SF)
    widths = [len(columns) for columns in stored["orders_featured"]]
    assert widths[0] == 1 and max(widths) < len(stages.clean(spark, SF).columns)
    stages.forget()


def test_items_are_stored_between_shuffles(spark, monkeypatch):
    def rows(joined):
        columns = sorted(joined.columns)
        return sorted(map(str, joined.select(columns).collect()))

    tables_ = stages.market(spark, SF)
    want = rows(marketplace.join_tables(tables_))
    monkeypatch.setattr(marketplace, "fits", lambda table: "seller_id" in table.columns)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        joined = marketplace.join_tables(tables_, staged=True)
        text = plan(joined)
        assert rows(joined) == want
    finally:
        spark.conf.set(limit, old)
    # the items and the orders by order; products, customers and points met theirs before
    assert text.count("Exchange hashpartitioning") == 2
