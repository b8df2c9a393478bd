"""Scans and sinks (S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixture, sql as S, stages
from checks.registry import query
from haulmetrics.functions.dates import date_formats, infer_formats, parse_timestamp
from haulmetrics.functions.numeric import to_number
from haulmetrics.plans import analytics, quality, report
from haulmetrics.schema import MARKET_DATES, ORDER_COLUMNS
from haulmetrics.session import new_path, stage
from haulmetrics.sources import csv, json_pages, landing, tables, versions

@query("s01_csv_scan", S.with_(S.RAW, f"""
SELECT {S.columns(ORDER_COLUMNS)} FROM shipments_raw WHERE source_system = 'dataco'"""))
def csv_scan(spark, sf):
    """The file holds the columns in another order, and others besides."""
    return csv.read_order_feed(spark, stages.order_csv(spark, sf, "dataco"))


@query("s01_quoted_line_breaks", """
SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderkey % 50 = 0 THEN 'first "line"' || chr(10) || chr(10)
    || o_orderpriority || ', last' ELSE o_orderpriority END AS note, o_orderstatus AS status
FROM orders""")
def quoted_line_breaks(spark, sf):
    """Every fiftieth record goes on over three lines, with quotes and commas in them."""
    path = new_path(spark, "line_breaks")
    priority = F.col("o_orderpriority")
    long = F.concat(F.lit('first "line"\n\n'), priority, F.lit(", last"))
    tables.write_csv(fixture.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 50 == 0, long).otherwise(priority).alias("note"),
        F.col("o_orderstatus").alias("status")), path)
    return csv.read_csv(spark, path)


@query("s02_optional_second_feed", S.with_(S.RAW, """
SELECT 'both' AS run, source_system, count(*) AS orders, count(order_id) AS ids
FROM shipments_raw GROUP BY source_system
UNION ALL SELECT 'first only', source_system, count(*), count(order_id)
FROM shipments_raw WHERE source_system = 'dataco' GROUP BY source_system"""))
def optional_second_feed(spark, sf):
    first, second = (stages.order_csv(spark, sf, s) for s in ("dataco", "olist"))
    runs = {"both": csv.extract_orders(spark, first, second),
            "first only": csv.extract_orders(spark, first, second + "-absent")}
    parts = [df.groupBy(F.lit(name).alias("run"), "source_system").agg(
        F.count("*").alias("orders"), F.count("order_id").alias("ids"))
        for name, df in runs.items()]
    return csv.stack(parts)


@query("s03_csv_bad_bytes", """
SELECT c_custkey::VARCHAR AS id, 'caf' || chr(65533) || ' ' || c_name AS name FROM customer""")
def csv_bad_bytes(spark, sf):
    path = new_path(spark, "latin1")
    rows = fixture.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat(F.lit("café "), F.col("c_name")).alias("name"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return csv.read_csv(spark, path)


_DATES_SQL = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in MARKET_DATES)


@query("s04_csv_dates", S.with_(S.MARKET, f"SELECT order_id, {_DATES_SQL} FROM m_orders"))
def csv_dates(spark, sf):
    orders = csv.read_market_table(spark, stages.market_csv(spark, sf), "orders")
    return orders.select("order_id", *MARKET_DATES)


#: Feeds that write their dates in a form of their own; the last one mixes two.
_DATE_FEEDS = {"day first": "dd/MM/yyyy", "month first": "MM/dd/yyyy HH:mm:ss",
               "month names": "dd-MMM-yyyy", "dots": "d.M.yyyy", "mixed": "dd/MM/yyyy"}


def _date_feeds(spark, sf):
    orders = fixture.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    for feed, form in _DATE_FEEDS.items():
        text = F.date_format("o_orderdate", form)
        if feed == "mixed":
            text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")) \
                .otherwise(text)
        yield feed, stage(orders.select("o_orderkey", text.alias("order_date")), "dates")


@query("s04_inferred_dates", f"""
SELECT feed, o_orderkey, strftime(o_orderdate::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS order_date
FROM orders, (SELECT unnest({list(_DATE_FEEDS)}) AS feed)""")
def inferred_dates(spark, sf):
    return csv.stack([
        df.select(F.lit(feed).alias("feed"), "o_orderkey",
                  parse_timestamp("order_date", infer_formats(df, "order_date")).alias("order_date"))
        for feed, df in _date_feeds(spark, sf)])


@query("s04_date_formats", """
WITH t AS (SELECT o_orderkey % 2 = 0 AS even, day(o_orderdate) <= 12 AS low FROM orders),
found(feed, format, parsed, chosen, place) AS (
  SELECT 'day first', 'd/M/yyyy[ H:mm[:ss]]', count(*), count(*), 1 FROM t
  UNION ALL SELECT 'day first', 'M/d/yyyy[ H:mm[:ss]]', count(*) FILTER (low), 0, 2 FROM t
  UNION ALL SELECT 'month first', 'M/d/yyyy[ H:mm[:ss]]', count(*), count(*), 1 FROM t
  UNION ALL SELECT 'month first', 'd/M/yyyy[ H:mm[:ss]]', count(*) FILTER (low), 0, 2 FROM t
  UNION ALL SELECT 'mixed', 'ISO', count(*) FILTER (even), count(*) FILTER (even), 1 FROM t
  UNION ALL SELECT 'mixed', 'd/M/yyyy[ H:mm[:ss]]', count(*) FILTER (NOT even),
    count(*) FILTER (NOT even), 2 FROM t
  UNION ALL SELECT 'mixed', 'M/d/yyyy[ H:mm[:ss]]', count(*) FILTER (NOT even AND low), 0, 3 FROM t)
SELECT feed, format, parsed, parsed / (SELECT count(*) FROM t) AS share,
  parsed = (SELECT count(*) FROM t) AS fits_all, place::INTEGER AS place, chosen,
  false AS ambiguous FROM found""")
def date_format_report(spark, sf):
    return csv.stack([date_formats(df, "order_date").withColumn("feed", F.lit(feed))
                      for feed, df in _date_feeds(spark, sf)
                      if feed in ("day first", "month first", "mixed")])


_CONTENTS = {
    "orders": (["order_id", "customer_id", "order_status"], []),
    "items": (["order_id", "order_item_id", "product_id", "seller_id"], ["price", "freight_value"]),
    "products": (["product_id", "product_category_name"], ["product_weight_g"]),
    "customers": (["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                   "customer_city", "customer_state"], []),
    "sellers": (["seller_id", "seller_zip_code_prefix", "seller_state"], []),
    "geolocation": (["geolocation_zip_code_prefix"], ["geolocation_lat", "geolocation_lng"]),
    "translation": (["product_category_name", "product_category_name_english"], []),
}
_SEVEN = "\nUNION ALL ".join(
    f"SELECT '{name}' AS name, concat_ws('|', {', '.join(f'{c}::VARCHAR' for c in texts)}) AS texts,"
    f" {f'{numbers[0]}::DOUBLE' if numbers else 'NULL::DOUBLE'} AS number1,"
    f" {f'{numbers[1]}::DOUBLE' if numbers[1:] else 'NULL::DOUBLE'} AS number2 FROM m_{name}"
    for name, (texts, numbers) in _CONTENTS.items())


@query("s05_seven_tables", S.with_(S.MARKET, _SEVEN))
def seven_tables(spark, sf):
    """All rows of all tables: the text columns joined, and the numbers."""
    read = csv.read_market(spark, stages.market_csv(spark, sf))

    def shown(name, texts, numbers):
        columns = [F.col(c).cast("double") for c in numbers] + [F.lit(None).cast("double")] * 2
        return read[name].select(
            F.lit(name).alias("name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in texts]).alias("texts"),
            columns[0].alias("number1"), columns[1].alias("number2"))

    return csv.stack([shown(name, *columns) for name, columns in _CONTENTS.items()])


def _column_type(position: int, name: str) -> str:
    text = f"{name}::VARCHAR"
    kind = f"""CASE WHEN count({name}) = 0 THEN 'text'
      WHEN bool_and(regexp_full_match({text}, '[+-]?[0-9]+')) THEN 'integer'
      WHEN bool_and(regexp_full_match({text}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'))
        THEN 'number' ELSE 'text' END"""
    return (f"SELECT {position} AS position, '{name}' AS \"column\", {kind} AS type,"
            f" count({name}) AS known FROM shipments_raw WHERE source_system = 'dataco'")


@query("s06_inspect_columns", S.with_(S.RAW, "\nUNION ALL ".join(
    _column_type(i, c) for i, c in enumerate(ORDER_COLUMNS, start=1))))
def inspect_columns(spark, sf):
    feed = csv.read_csv(spark, stages.order_csv(spark, sf, "dataco"), ORDER_COLUMNS)
    return tables.describe_columns(feed)


_EVENTS_SQL = S.with_(S.EVENTS, f"SELECT {S.EVENT_TEXT} FROM clean_events")


@query("s07_paged_json", _EVENTS_SQL)
def paged_json(spark, sf):
    path = new_path(spark, "pages")
    tables.write_json(json_pages.to_pages(stages.events(spark, sf)), path)
    return json_pages.extract_events(spark, path)


@query("s07_landed_pages", _EVENTS_SQL)
def landed_pages(spark, sf):
    """The pages land in three parts; the last part brings all those of the first again."""
    inbox, store = new_path(spark, "inbox"), new_path(spark, "landed")
    pages = stage(json_pages.to_pages(stages.events(spark, sf)), "pages")
    for parts in ([1], [2], [0, 1]):
        pages.where((F.col("page") % 3).isin(parts)).write.mode("append").json(inbox)
        landing.land_pages(spark, inbox, store)
    return landing.landed_events(spark, store)


@query("s07_page_ledger", S.with_(S.EVENTS + """,
p AS (SELECT count(*) AS total_rows, ceil(count(*) / 500)::BIGINT AS pages FROM clean_events),
n AS (SELECT unnest(range(1, pages + 1)) AS page, pages, total_rows FROM p)""", """
SELECT page, 500 AS page_size, total_rows,
  CASE WHEN page < pages THEN 500 ELSE total_rows - 500 * (pages - 1) END AS n_rows
FROM n WHERE page % 2 = 1"""))
def page_ledger(spark, sf):
    """Only every other page has landed, each twice."""
    inbox, store = new_path(spark, "inbox"), new_path(spark, "landed")
    pages = stage(json_pages.to_pages(stages.events(spark, sf)).where("page % 2 = 1"), "pages")
    for _ in range(2):
        pages.write.mode("append").json(inbox)
        landing.land_pages(spark, inbox, store)
    return landing.ledger(spark, store).select("page", "page_size", "total_rows", "n_rows")


@query("s08_json_object_rows", """
SELECT k AS carrier, (props::JSON ->> k)::DOUBLE AS api_on_time_rate, event_id
FROM (SELECT event_id, props, unnest(json_keys(props::JSON)) AS k FROM events)""")
def json_object_rows(spark, sf):
    events = fixture.table(spark, sf, "events")
    return json_pages.explode_rates(events, "props", keep=("event_id",))


_RAW_ALL = S.with_(S.RAW, f"SELECT {S.columns([*ORDER_COLUMNS, 'source_system'])} FROM shipments_raw")


@query("s09_sql_scan", _RAW_ALL)
def sql_scan(spark, sf):
    return tables.scan_sql(stages.raw(spark, sf), "orders_raw")


@query("s10_parquet_scan", "SELECT * FROM supplier")
def parquet_scan(spark, sf):
    return tables.read_parquet(spark, f"{sf}/supplier.parquet")


@query("s11_raw_tables", S.with_(S.RAW + "," + S.EVENTS, f"""
SELECT 'orders_raw' AS name, concat_ws('|', order_id, carrier, delay_reason) AS content,
  quantity::DOUBLE AS number FROM shipments_raw
UNION ALL SELECT 'shipping_events_raw', concat_ws('|', {S.columns(S.EVENT_COLUMNS)}), NULL
FROM tracking_raw
UNION ALL SELECT 'carrier_performance_raw', carrier,
  {S.r("1 - count(*) FILTER (event_type = 'DELAYED') / count(*)", 4)}
FROM clean_events GROUP BY carrier"""))
def raw_tables(spark, sf):
    """All three raw tables, replaced and read back from the catalog."""
    rates = report.carrier_event_rate(stages.events(spark, sf))
    shown = {"orders_raw": (stages.raw(spark, sf), ["order_id", "carrier", "delay_reason"],
                            F.col("quantity").cast("double")),
             "shipping_events_raw": (stages.tracking(spark, sf), S.EVENT_COLUMNS,
                                     F.lit(None).cast("double")),
             "carrier_performance_raw": (rates, ["carrier"], F.col("on_time_rate"))}
    tables.store_raw({f"haulmetrics_{name}": df for name, (df, *_) in shown.items()},
                     new_path(spark, "raw_tables"))
    return csv.stack([spark.table(f"haulmetrics_{name}").select(
        F.lit(name).alias("name"), F.concat_ws("|", *texts).alias("content"),
        number.alias("number")) for name, (_, texts, number) in shown.items()])


@query("s11_versioned_table", S.with_(S.CLEAN, f"""
SELECT order_id, carrier, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date,
  quantity + CASE WHEN month(order_date) = 3 THEN 1000 ELSE 0 END AS quantity
FROM clean WHERE month(order_date) <> 5"""))
def versioned_table(spark, sf):
    """Stored by month without March; then March comes with other quantities, and May goes."""
    folder = new_path(spark, "versioned")
    rows = stages.clean(spark, sf).select("order_id", "carrier", "order_date", "quantity")
    rows = rows.withColumn("month", F.date_format("order_date", "yyyy-MM"))
    march = F.month("order_date") == 3
    versions.replace_table(rows.where(~march), folder, part="month")
    versions.replace_parts(rows.where(march).withColumn("quantity", F.col("quantity") + 1000),
                           folder)
    may = [p for p in versions.parts(spark, folder) if p.endswith("-05")]
    versions.drop_parts(spark, folder, may)
    return versions.read_table(spark, folder).drop("month")


@query("s12_parquet_sink", _EVENTS_SQL)
def parquet_sink(spark, sf):
    path = new_path(spark, "sink")
    tables.write_parquet(stages.events(spark, sf), path)
    return tables.read_parquet(spark, path)


@query("s13_microsecond_times", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events""")
def microsecond_times(spark, sf):
    nanos = fixture.table(spark, sf, "events").select(
        "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + 7).alias("ts"))
    return tables.to_microseconds(nanos, ["ts"]).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"))


@query("s14_analytics_sink", S.with_(S.FEATURED, """
SELECT 'carrier_monthly_performance' AS name, count(*) AS n FROM
  (SELECT DISTINCT carrier, order_month FROM featured)
UNION ALL SELECT 'region_route_summary', count(*) FROM
  (SELECT DISTINCT destination_region, distance_category FROM featured)
UNION ALL SELECT 'rolling_delay_trend', count(*) FROM featured"""))
def analytics_sink(spark, sf):
    rows = stages.featured(spark, sf, *analytics.COLUMNS)
    paths = analytics.write_analytics(rows, new_path(spark, "analytics"))
    return csv.stack([spark.read.parquet(path).agg(F.lit(name).alias("name"),
                                                   F.count("*").alias("n"))
                      for name, path in paths.items()])


_SUNK = ["order_id", "product_category", "carrier", "order_status", "delay_reason",
         "destination_city", "source_system"]
_SUNK_NUMBERS = ["quantity", "unit_price", "distance_km", "weight_kg", "shipping_cost",
                 "actual_delivery_days"]


@query("s15_csv_sink", S.with_(S.CLEAN, f"""
SELECT {S.columns(_SUNK)}, {", ".join(f"{c}::DOUBLE AS {c}" for c in _SUNK_NUMBERS)},
  strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date FROM clean"""))
def csv_sink(spark, sf):
    """Text, numbers and times written as CSV and read back."""
    path = new_path(spark, "csv_sink")
    tables.write_csv(stages.clean(spark, sf), path, compression="gzip")
    rows = csv.read_csv(spark, path, [*_SUNK, *_SUNK_NUMBERS, "order_date"])
    return rows.withColumns({**{c: to_number(c) for c in _SUNK_NUMBERS},
                             "order_date": parse_timestamp("order_date")})


@query("s16_json_sink", S.with_(S.FEATURED, """
SELECT count(*) AS dataset_rows, 21 AS total_expectations,
       20 + (count(*) FILTER (unit_price NOT BETWEEN 0 AND 10000) = 0)::INTEGER AS passed
FROM featured"""))
def json_sink(spark, sf):
    path = new_path(spark, "quality_json")
    df = stages.featured(spark, sf)
    tables.write_json(quality.report(quality.validate(df), len(df.columns)), path)
    return tables.read_document(spark, path).select(
        "dataset_rows", F.col("total_expectations"), "passed")


@query("s17_materialise_and_count", S.with_(S.FEATURED, "SELECT count(*) AS n FROM featured"))
def materialise_and_count(spark, sf):
    kept, n = tables.cached(stages.featured(spark, sf).select("order_id"))
    kept.unpersist()
    return spark.createDataFrame([(n,)], "n bigint")


@query("s18_json_document", S.with_(S.FEATURED, """
SELECT destination_region AS label, count(*)::DOUBLE AS value FROM featured GROUP BY 1"""))
def json_document(spark, sf):
    path = new_path(spark, "summary")
    tables.write_json(report.summary_documents(report.summary_rows(stages.featured(spark, sf))),
                      path)
    regions = tables.read_document(spark, path).where("section = 'orders_by_region'")
    return json_pages.explode_rates(regions, "document", "label", "value")


@query("s19_first_existing_source", "SELECT count(*) AS n FROM orders")
def first_existing_source(spark, sf):
    found = tables.read_first(spark, [f"{sf}/no_such_table.parquet", f"{sf}/orders.parquet"])
    return found.agg(F.count("*").alias("n"))
