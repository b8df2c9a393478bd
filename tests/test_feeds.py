"""Feeds: header mapping, ids, CSV reading, paged JSON, marketplace edge cases."""

import csv as python_csv
import json
import random

import pytest
from pyspark.sql import functions as F

from haulmetrics.plans import mapping, marketplace
from haulmetrics.schema import HEADER_ALIASES, ORDER_COLUMNS
from haulmetrics.session import stage
from haulmetrics.sources import csv, json_pages, tables


def test_headers_match_in_any_spelling():
    found = mapping.match_headers(["ORDER-DATE", "Order Item Id", "Order Id", "qty", "Lat", "odd"])
    assert found.matched["order_id"] == "Order Id"  # the canonical name itself comes first
    assert found.matched["order_date"] == "ORDER-DATE"
    assert found.matched["quantity"] == "qty"
    assert found.matched["destination_latitude"] == "Lat"
    assert "carrier" in found.missing
    assert set(HEADER_ALIASES) == set(ORDER_COLUMNS)


def feed(spark, ids):
    rows = [(i, "1/31/2018 22:56", str(n)) for n, i in enumerate(ids)]
    return stage(spark.createDataFrame(rows, "`Order Item Id` string, `Order Date` string,"
                                             " qty string"), "feed")


@pytest.mark.parametrize("ids,want", [
    (["a-1", "b2", "3"], {"ORD-1", "ORD-2", "ORD-3"}),
    (["a", "a", "b"], {"ORD-0000001", "ORD-0000002", "ORD-0000003"}),
    ([None, "1", "2"], None), ([None, None, "7"], {"ORD-0000001", "ORD-0000002", "ORD-0000003"}),
    ([None, None, None], {"ORD-0000001", "ORD-0000002", "ORD-0000003"})])
def test_order_ids(spark, ids, want):
    got = [r["order_id"] for r in mapping.map_to_schema(feed(spark, ids)).collect()]
    assert len(got) == 3 and all(g.startswith("ORD-") and g[4:].isdigit() for g in got)
    if want:
        assert set(got) == want


def test_mapping_needs_dates(spark):
    with pytest.raises(ValueError, match="order date"):
        mapping.map_to_schema(feed(spark, ["1"]).drop("Order Date"))


def test_mapping_fills_only_absent_columns(spark):
    df = mapping.map_to_schema(feed(spark, ["1", "2", "3"]))
    assert df.columns == ORDER_COLUMNS
    rows = df.collect()
    assert {r["quantity"] for r in rows} == {0.0, 1.0, 2.0}
    for r in rows:
        assert 5 <= r["unit_price"] <= 500 and 10 <= r["distance_km"] <= 12000
        assert 2 <= r["promised_delivery_days"] <= 11 and r["actual_delivery_days"] >= 1
        assert -2 <= r["actual_delivery_days"] - r["promised_delivery_days"] <= 4 \
            or r["actual_delivery_days"] == 1
        assert r["customer_id"].startswith("CUST-") and len(r["product_id"]) == 9
        assert r["origin_warehouse_id"] == "WH-001" and r["delay_reason"] == "None"
        assert r["order_status"] == "DELIVERED" and r["product_category"] == "Unknown"
    again = mapping.map_to_schema(feed(spark, ["1", "2", "3"]).repartition(3)).collect()
    key = lambda r: r["order_id"]
    assert sorted(rows, key=key) == sorted(again, key=key)


def test_csv_words_for_missing(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        'order_id,carrier,delay_reason,quantity\n1,NA,None,2\n2,"a, ""b""",Late,nan\n3,,,x\n')
    rows = [tuple(r) for r in csv.typed_orders(
        csv.read_csv(spark, str(tmp_path / "f.csv"))).orderBy("order_id").collect()]
    assert rows == [("1", None, "None", 2.0), ("2", 'a, "b"', "Late", None),
                    ("3", None, None, None)]


def test_csv_bad_bytes(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"name\ncaf\xe9\n")
    assert csv.read_csv(spark, str(tmp_path / "f.csv")).first()["name"] == "caf�"


def test_second_feed_is_optional_first_is_not(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,quantity\n1,2\n")
    (tmp_path / "b.csv").write_text("order_id,weight_kg\nx,3\n")
    a, b, c = (str(tmp_path / f"{n}.csv") for n in "abc")
    assert csv.extract_orders(spark, a, c).count() == 1
    both = {r["source_system"]: (r["order_id"], r["quantity"], r["weight_kg"])
            for r in csv.extract_orders(spark, a, b).collect()}
    assert both == {"dataco": ("1", 2.0, None), "olist": ("x", None, 3.0)}
    with pytest.raises(FileNotFoundError):
        csv.extract_orders(spark, c, b)


def test_missing_page_is_noticed(spark, tmp_path):
    event = dict(order_id="o", carrier="c", event_timestamp="t", event_type="e", location="l",
                 delay_reason="d")
    for page, n in ((1, 2), (2, 1)):
        (tmp_path / f"p{page}.json").write_text(json.dumps(
            dict(page=page, page_size=2, total_rows=3, results=[event] * n), indent=1))
    read = lambda path: json_pages.extract_events(spark, path, document_per_file=True)
    assert read(str(tmp_path)).count() == 3
    with pytest.raises(ValueError, match="received 2 of 3"):
        read(str(tmp_path / "p1.json"))


def test_pages_hold_page_size_rows(spark):
    events = spark.range(1_100).select(*[F.concat(F.lit(c), F.col("id").cast("string")).alias(c)
                                         for c in json_pages.EVENT_COLUMNS])
    sizes = {r["page"]: (r["n"], r["total_rows"]) for r in json_pages.to_pages(events).select(
        "page", "total_rows", F.size("results").alias("n")).collect()}
    assert sizes == {1: (500, 1_100), 2: (500, 1_100), 3: (100, 1_100)}


def test_carrier_rates(spark):
    df = spark.createDataFrame([('{"A": 0.5, "B": 1}',)], "doc string")
    assert {tuple(r) for r in json_pages.explode_rates(df, "doc").collect()} == {
        ("A", 0.5), ("B", 1.0)}


def test_sources_and_sinks(spark, tmp_path):
    df = spark.sql("select timestamp'2024-01-02 03:04:05.678901' as t, ' x ' as s")
    tables.write_parquet(df, str(tmp_path / "p"))
    assert tables.read_first(spark, [str(tmp_path / "no"), str(tmp_path / "p")]).collect() \
        == df.collect()
    tables.write_csv(df, str(tmp_path / "c"))
    assert csv.read_csv(spark, str(tmp_path / "c")).first()["s"] == " x "
    with pytest.raises(FileNotFoundError):
        tables.read_first(spark, [str(tmp_path / "no")])
    with pytest.raises(ValueError, match="clean: 0 rows"):
        tables.require_nonempty(df.where("false"), "clean")


def market_row(spark, **changes):
    base = dict(order_id="o1", order_item_id=1, product_id="p" * 20, seller_id="s" * 20,
                customer_id="c" * 20, customer_unique_id="u", order_status="delivered",
                order_purchase_timestamp="2024-01-01 10:00:00",
                order_approved_at=None, order_delivered_carrier_date="2024-01-02 10:00:00",
                order_delivered_customer_date="2024-01-09 09:00:00",
                order_estimated_delivery_date="2024-01-07 10:00:00", price=1.0, freight_value=2.0,
                product_category_name="cama_mesa", product_category_name_english=None,
                product_weight_g=1500.0, customer_city="sao paulo", customer_state="SP",
                seller_state="RJ", geolocation_lat_cust=0.0, geolocation_lng_cust=0.0,
                geolocation_lat_sell=0.0, geolocation_lng_sell=90.0)
    row = {**base, **changes}
    kinds = {int: "int", float: "double"}
    schema = ", ".join(f"{k} {kinds.get(type(base[k]), 'string')}" for k in base)
    df = spark.createDataFrame([tuple(row[k] for k in base)], schema)
    return csv.typed_market(df)


def test_marketplace_mapping(spark):
    df = stage(csv.stack([
        market_row(spark), market_row(spark, order_id="o2", customer_unique_id="v",
                                      order_delivered_customer_date=None,
                                      product_category_name_english="bed_bath"),
        market_row(spark, order_id="o3", product_category_name=None,
                   order_delivered_customer_date="2024-01-01 08:00:00"),
        market_row(spark, order_id="o4", customer_unique_id="w", geolocation_lat_sell=None)]), "m")
    mapped = stage(marketplace.map_to_schema(df), "mm")
    rows = {(r["product_category"], r["actual_delivery_days"], r["distance_km"]): r
            for r in mapped.collect()}
    first = rows[("Cama Mesa", 7, 10007.54)]
    assert first["delay_reason"] == "Late delivery" and first["promised_delivery_days"] == 6
    assert first["customer_segment"] == "Returning" and first["destination_city"] == "Sao Paulo"
    assert first["customer_id"] == "CUST-" + "c" * 12 and first["carrier"] == "Seller-ssssss"
    assert rows[("Bed Bath", None, 10007.54)]["delay_reason"] == "Not delivered"
    assert rows[(None, -1, 10007.54)]["delay_reason"] == "None"
    assert ("Cama Mesa", 7, None) in rows
    assert {r["order_id"] for r in rows.values()} == {f"ORD-OLIST-{i:07d}" for i in range(1, 5)}
    events = marketplace.milestone_events(mapped)
    kinds = {k: n for k, n in events.groupBy("event_type").count().collect()}
    assert kinds == {"ORDER_PLACED": 4, "HANDED_TO_CARRIER": 4, "DELIVERED": 3}
    late = events.where("delay_reason = 'Late delivery'").select("event_type").distinct()
    assert [r[0] for r in late.collect()] == ["DELIVERED"]


def test_buyers_without_id_are_one_group(spark):
    df = stage(spark.createDataFrame([(None,), (None,), ("x",)], "customer_unique_id string"), "b")
    got = sorted((r[0] or "", r[1]) for r in marketplace.buyer_segment(df).collect())
    assert got == [("", "Returning"), ("", "Returning"), ("x", "New")]


def test_raw_tables_are_replaced(spark, tmp_path):
    for n in (3, 5):
        names = tables.store_raw({"t_orders": spark.range(n), "t_events": spark.range(n + 1)},
                                 str(tmp_path / str(n)))
        assert [spark.table(t).count() for t in names] == [n, n + 1]
    spark.sql("drop table t_orders")
    spark.sql("drop table t_events")


def test_analytics_tables_written(spark, tmp_path):
    from haulmetrics.plans.analytics import write_analytics
    df = spark.sql("""select 'o1' order_id, 'A' carrier, timestamp'2024-01-01' order_date,
        2 delivery_delay, 1 is_delayed, 1.5D shipping_cost_per_unit, 0.5D carrier_performance_score,
        'r' destination_region, 'Local' distance_category, 0.5D route_efficiency_score,
        10.0D distance_km""")
    paths = write_analytics(df, str(tmp_path))
    assert {name: spark.read.parquet(p).count() for name, p in paths.items()} == {
        "carrier_monthly_performance": 1, "region_route_summary": 1, "rolling_delay_trend": 1}


def test_work_folder_needs_a_shared_path_on_a_cluster():
    from haulmetrics.session import work_dir

    class Session:
        conf = {"spark.app.id": "a", "spark.master": "yarn"}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs://shared/dir/"
    assert work_dir(Session()) == "hdfs://shared/dir/haulmetrics-a"


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "items.csv").write_text(
        "seller_id,extra,price,order_id\ns,x,58.90,o\n")
    got = csv.read_csv(spark, str(tmp_path / "items.csv"), ["order_id", "price", "weight"],
                       optional=["weight"]).first()
    assert got.asDict() == {"order_id": "o", "price": "58.90", "weight": None}
    with pytest.raises(ValueError, match="weight"):
        csv.read_csv(spark, str(tmp_path / "items.csv"), ["order_id", "weight"])


def test_order_feed_in_another_order(spark, tmp_path):
    names = list(reversed(ORDER_COLUMNS))
    row = ["7" if n == "quantity" else "ORD-1" if n == "order_id" else "" for n in names]
    (tmp_path / "f.csv").write_text(",".join(["note", *names]) + "\n" + ",".join(["n", *row]) + "\n")
    got = csv.read_order_feed(spark, str(tmp_path / "f.csv")).first()
    assert (got["order_id"], got["quantity"]) == ("ORD-1", 7.0)


def test_quoted_line_breaks(spark, tmp_path):
    path = str(tmp_path / "f.csv")
    (tmp_path / "f.csv").write_text('a,b\n"one\ntwo",x\n"say ""hi""",y\n')
    assert csv.torn_records(spark, path).count() == 2
    expected = {("one\ntwo", "x"), ('say "hi"', "y")}
    assert {tuple(r) for r in csv.read_csv(spark, path).collect()} == expected
    assert {tuple(r) for r in csv.read_csv(spark, path, multi_line=True).collect()} == expected


@pytest.mark.parametrize("block", [97, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_across_blocks(spark, tmp_path, block, end):
    """Records that begin in one block and end in another, or hold whole blocks."""
    draw = random.Random(block)
    rows = [(str(i), "".join(draw.choices(["x", "\n", '"', ",", "word "], k=draw.choice([0, 3, 300]))))
            for i in range(80)] + [("last", "y")]
    folder = tmp_path / "feed"
    folder.mkdir()
    for name, part in (("a.csv", rows[:50]), ("b.csv", rows[50:])):
        with open(folder / name, "w", newline="") as out:
            writer = python_csv.writer(out, lineterminator=end)
            writer.writerow(["id", "note"])
            writer.writerows(part)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = [tuple(r) for r in csv.read_csv(spark, str(folder), ["id", "note"]).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted((i, t) for i, t in rows) or \
        sorted((i, t or "") for i, t in got) == sorted(rows)


def test_torn_feeds_are_read_whole_by_every_entry(spark, tmp_path):
    row = {n: "" for n in ORDER_COLUMNS} | {"order_id": "ORD-1", "carrier": "two\nlines"}
    with open(tmp_path / "f.csv", "w", newline="") as out:
        writer = python_csv.DictWriter(out, ORDER_COLUMNS)
        writer.writeheader()
        writer.writerows([row, row | {"order_id": "ORD-2"}])
    path = str(tmp_path / "f.csv")
    for feed in (csv.extract_orders(spark, path), csv.read_order_feed(spark, path)):
        assert sorted((r["order_id"], r["carrier"]) for r in feed.collect()) == [
            ("ORD-1", "two\nlines"), ("ORD-2", "two\nlines")]


def test_quotes_must_balance(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n"one\ntwo,x\n')
    with pytest.raises(ValueError, match="balance"):
        csv.read_csv(spark, str(tmp_path / "f.csv"))


def test_a_repeated_page_hides_no_missing_one(spark, tmp_path):
    event = dict(order_id="1", carrier="c", event_timestamp="t", event_type="e", location="l",
                 delay_reason="d")
    for name, page in (("a", 1), ("b", 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps(
            dict(page=page, page_size=2, total_rows=4, results=[event] * 2)))
    with pytest.raises(ValueError, match="1 of 2 pages"):
        json_pages.extract_events(spark, str(tmp_path), document_per_file=True)


def test_split_csv_keeps_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(' a "q" ', 1.5)], "t string, n double")
    tables.write_csv(df, str(tmp_path / "c"))
    assert tuple(csv.read_csv(spark, str(tmp_path / "c")).first()) == (' a "q" ', "1.5")


def test_nanosecond_parquet(spark, tmp_path):
    pa = pytest.importorskip("pyarrow")
    import pyarrow.parquet as pq
    stamp = pa.array([1_700_000_000_123_456_789, None], pa.timestamp("ns"))
    pq.write_table(pa.table({"ts": stamp}), tmp_path / "n.parquet", version="2.6")
    got = tables.to_microseconds(tables.read_parquet(spark, str(tmp_path / "n.parquet")), ["ts"])
    shown = got.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).collect()
    assert [r[0] for r in shown] == ["2023-11-14 22:13:20.123456", None]


def test_column_types_are_inferred(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "2024-01-31", "x", None, 3), ("-2", "2e3", "1/31/2018", "1", None, 4)],
        "i string, n string, t string, s string, e string, k int")
    got = {r["column"]: (r["type"], r["known"]) for r in tables.describe_columns(df).collect()}
    assert got == {"i": ("integer", 2), "n": ("number", 2), "t": ("timestamp", 2), "s": ("text", 2),
                   "e": ("text", 0), "k": ("int", 2)}


def test_ids_share_one_numbering(spark):
    rows = stage(spark.createDataFrame([(f"1/{d}/2018",) for d in range(1, 9)], "`Order Date` string"),
                 "dates")
    out = mapping.map_to_schema(rows)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Window") <= 4
    got = sorted((r["order_id"], r["customer_id"], r["product_id"]) for r in out.collect())
    assert got == [(f"ORD-{i:07d}", f"CUST-{i - 1:05d}", f"PROD-{i - 1:04d}") for i in range(1, 9)]
