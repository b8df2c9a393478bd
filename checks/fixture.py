"""Shipment feeds derived from the given tables, with deterministic defects.

Every expression here has a SQL twin in ``checks/sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.functions.numeric import haversine_km, round_even
from haulmetrics.operators.attach import fits
from haulmetrics.schema import ORDER_COLUMNS
from haulmetrics.session import spread, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word(column: str) -> Column:
    return (F.when(F.col(column) == "F", "finished").when(F.col(column) == "O", "open")
            .otherwise("partial"))


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer, part, supplier, nations and regions."""
    t = lambda name: table(spark, sf_dir, name)
    nation = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    side = lambda p: nation.select(F.col("n_nationkey").alias(f"{p}_nk"),
                                   F.col("n_name").alias(f"{p}_nation"),
                                   F.col("r_name").alias(f"{p}_region"))
    # customers are joined to the orders, which are fewer than the lines; suppliers, the
    # fewest, come last, so that the shuffle of the lines does not carry their columns. The
    # planner takes a join to be as large as the product of its sides and would shuffle the
    # lines for the suppliers' nations, so suppliers are stored and broadcast by their size
    orders = (t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(F.broadcast(side("c")), F.col("c_nationkey") == F.col("c_nk")))
    suppliers = stage(t("supplier").select("s_suppkey", "s_name", "s_nationkey")
                      .join(F.broadcast(side("s")), F.col("s_nationkey") == F.col("s_nk")),
                      "suppliers")
    return (spread(t("lineitem"))
            .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(F.broadcast(suppliers) if fits(suppliers) else suppliers,
                  F.col("l_suppkey") == F.col("s_suppkey")))


def line_key() -> Column:
    return F.concat(F.col("l_orderkey").cast("string"),
                    F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
                    F.lpad(F.col("l_partkey").cast("string"), 12, "0"),
                    F.lpad(F.col("l_suppkey").cast("string"), 12, "0"),
                    F.date_format("l_shipdate", "yyyyMMdd"))


def _days_taken() -> Column:
    days = F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date"))
    return F.pmod(days, F.lit(15)).cast("double")


def _promised() -> Column:
    level = F.substring("o_orderpriority", 1, 1)
    return (F.when(level == "1", 0.0).when(level == "2", 2.0).when(level == "3", 5.0)
            .when(level == "4", 8.0).otherwise(12.0))


def shipments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical raw orders plus ``source_system``, defects and duplicates included."""
    lat = lambda p: -60.0 + 5.0 * F.col(f"{p}_nk")
    lon = lambda p: -150.0 + 12.0 * F.col(f"{p}_nk")
    distance = F.when(F.col("l_orderkey") % 151 != 0,
                      round_even(haversine_km(lat("s"), lon("s"), lat("c"), lon("c")), 2))
    weight = F.when(F.col("p_partkey") % 97 != 0, F.col("p_size") * 0.5)
    actual = F.when(F.col("l_partkey") % 50 != 0, _days_taken())
    odd = F.col("l_suppkey") % 2 == 1
    noisy = F.when(F.col("l_partkey") % 25 == 0,
                   F.concat(F.lit("  "), F.lower("p_type"), F.lit("\t"))).otherwise(F.col("p_type"))
    slot = F.col("l_suppkey") % 12 + 1
    line = F.col("l_linenumber") % 4
    columns = {
        "order_id": F.concat(F.lit("ORD-"), line_key()),
        "order_date": F.when(F.col("l_orderkey") % 333 == 0, "2025-13-45")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        "customer_id": F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")),
        "customer_segment": F.col("c_mktsegment"),
        "product_id": F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")),
        "product_category": F.when(F.col("l_partkey") % 211 != 0, noisy),
        "quantity": F.col("l_quantity"),
        "unit_price": F.col("l_extendedprice") / F.col("l_quantity"),
        "discount_rate": F.col("l_discount"),
        "weight_kg": weight,
        "origin_warehouse_id": F.when(slot <= 8, F.concat(F.lit("WH-00"), slot.cast("string")))
        .otherwise(F.concat(F.lit("SELLER-"), F.col("l_suppkey").cast("string"))),
        "origin_region": F.col("s_region"),
        "destination_city": F.concat(F.lit("City "), F.col("c_nk").cast("string")),
        "destination_country": F.col("c_nation"),
        "destination_region": F.col("c_region"),
        "destination_latitude": F.when(F.col("c_custkey") % 101 == 0, F.lit(None))
        .when(F.col("c_custkey") % 67 == 0, 95.0).otherwise(lat("c")),
        "destination_longitude": lon("c"),
        "distance_km": distance,
        "carrier": F.when(F.col("l_linenumber") % 5 == 0,
                          F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")))
        .otherwise(F.col("s_name")),
        "shipping_mode": F.when(~odd, F.when(line == 0, "Same Day").when(line == 1, "First Class")
                                .when(line == 2, "Second Class").otherwise("Standard Class")),
        "promised_delivery_days": _promised(),
        "actual_delivery_days": actual,
        "shipping_cost": F.when(F.col("l_orderkey") % 100 != 0,
                                2.5 + 0.015 * distance + 0.9 * weight),
        "order_status": F.concat(word("o_orderstatus"), F.lit(" ")),
        "delay_reason": F.when(actual.isNull(), "Not delivered")
        .when(actual > _promised(), "Late delivery").otherwise("None"),
        "source_system": F.when(odd, "olist").otherwise("dataco"),
    }
    copies = F.when(F.col("l_orderkey") % 200 == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    return (star(spark, sf_dir)
            .select(*[columns[c].alias(c) for c in [*ORDER_COLUMNS, "source_system"]],
                    F.explode(copies).alias("__copy"))
            .drop("__copy"))


def tracking_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking events with padded types, malformed times and duplicates."""
    e = spread(table(spark, sf_dir, "events"))
    kind = F.when(F.col("event_type") == "error", "delayed").otherwise(F.col("event_type"))
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    return e.select(
        F.concat(F.lit("ORD-"), F.floor(F.col("event_id") / 5).cast("string")).alias("order_id"),
        F.concat(F.lit("USER-"), F.col("user_id").cast("string")).alias("carrier"),
        F.when(F.col("event_id") % 97 == 0, "2025-13-45")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_timestamp"),
        F.concat(F.lit(" "), kind, F.lit("\t")).alias("event_type"),
        F.concat(F.lit("LOC-"), (F.col("user_id") % 25).cast("string")).alias("location"),
        F.when(F.col("event_type") == "error", "Late delivery").otherwise("None")
        .alias("delay_reason"),
        F.explode(copies).alias("__copy")).drop("__copy")


def vendor_feed(spark: SparkSession, sf_dir: str, *, ids: str = "unique") -> DataFrame:
    """Order lines under foreign headers; ids unique, repeated or absent.

    Weight, distance, carrier and cost are not part of this feed.
    """
    key = {"unique": F.concat(F.lit("LN/"), line_key()),
           "repeated": F.col("l_orderkey").cast("string")}.get(ids)
    whole = lambda c: c.cast("int").cast("string")
    columns = {
        "order date (DateOrders)": F.date_format("o_orderdate", "M/d/yyyy H:mm"),
        "Customer Id": F.col("o_custkey").cast("string"),
        "Customer Segment": F.col("c_mktsegment"),
        "Product Card Id": F.col("l_partkey").cast("string"),
        "Category Name": F.col("p_type"),
        "Order Item Quantity": F.when(F.col("l_orderkey") % 61 == 0, "n.a.")
        .when(F.col("l_orderkey") % 59 == 0, F.concat(whole(F.col("l_quantity")), F.lit("D")))
        .otherwise(whole(F.col("l_quantity"))),
        "Order Item Discount Rate": F.format_string("%.2f", F.col("l_discount")),
        "Product Price": F.format_string("%.2f", F.col("l_extendedprice")),
        "Department Name": F.when(F.col("l_suppkey") % 9 != 0, F.col("s_name")),
        "Market": F.col("s_region"),
        "Order City": F.concat(F.lit("City "), F.col("c_nk").cast("string")),
        "Order Country": F.col("c_nation"),
        "Order Region": F.when(F.col("c_custkey") % 13 != 0, F.col("c_region")),
        "Latitude": whole(-60.0 + 5.0 * F.col("c_nk")),
        "Longitude": whole(-150.0 + 12.0 * F.col("c_nk")),
        "Days for shipment (scheduled)": whole(_promised()),
        "Days for shipping (real)": whole(_days_taken()),
        "Order Status": F.col("o_orderstatus"),
        "Delivery Status": F.when(_days_taken() > _promised(), "Late delivery"),
    }
    if key is not None:
        columns["Order Item Id"] = key
    else:
        del columns["Customer Id"], columns["Product Card Id"]
    return star(spark, sf_dir).select(*[value.alias(name) for name, value in columns.items()])


def market_text(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven marketplace tables as text columns, as a CSV export would hold them."""
    t = lambda name: table(spark, sf_dir, name)
    hexid = lambda mark, key: F.md5(F.concat(F.lit(mark), F.col(key).cast("string")))
    at = lambda seconds: F.date_format(
        F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + seconds),
        "yyyy-MM-dd HH:mm:ss")
    k = F.col("o_orderkey")
    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    taken = F.when(k % 77 == 0, F.lit(-18_000)).otherwise(
        (k % 20) * 86_400 + (k % 24) * 3_600)
    orders = spread(t("orders")).select(
        hexid("o-", "o_orderkey").alias("order_id"),
        hexid("c-", "o_orderkey").alias("customer_id"),
        word("o_orderstatus").alias("order_status"),
        at(F.lit(0)).alias("order_purchase_timestamp"),
        F.when(k % 40 != 0, at((k % 5) * 3_600)).alias("order_approved_at"),
        F.when(k % 30 != 0, at((1 + k % 3) * 86_400)).alias("order_delivered_carrier_date"),
        F.when(k % 25 != 0, at(taken)).alias("order_delivered_customer_date"),
        at((2 + k % 15) * 86_400 + 7_200).alias("order_estimated_delivery_date"))
    items = spread(t("lineitem")).select(
        hexid("o-", "l_orderkey").alias("order_id"),
        text("l_linenumber").alias("order_item_id"),
        hexid("p-", "l_partkey").alias("product_id"),
        hexid("s-", "l_suppkey").alias("seller_id"),
        F.format_string("%.2f", F.col("l_extendedprice")).alias("price"),
        F.format_string("%.2f", F.col("l_quantity") * 0.5).alias("freight_value"))
    native = F.concat(F.lit("cat_"), F.lower("p_type"))
    products = t("part").select(
        hexid("p-", "p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 97 != 0, native).alias("product_category_name"),
        F.when(F.col("p_partkey") % 89 != 0, text(F.col("p_size") * 100))
        .alias("product_weight_g"))
    customers = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        hexid("c-", "o_orderkey").alias("customer_id"),
        hexid("u-", "o_custkey").alias("customer_unique_id"),
        text("c_nationkey").alias("customer_zip_code_prefix"),
        F.concat(F.lit("porto "), text("c_nationkey")).alias("customer_city"),
        F.concat(F.lit("S"), text(F.col("c_nationkey") % 5)).alias("customer_state"))
    sellers = t("supplier").select(
        hexid("s-", "s_suppkey").alias("seller_id"),
        text("s_nationkey").alias("seller_zip_code_prefix"),
        F.concat(F.lit("S"), text(F.col("s_nationkey") % 5)).alias("seller_state"))
    nk, ck = F.col("c_nationkey"), F.col("c_custkey")
    geolocation = t("customer").where(nk != 13).select(
        text("c_nationkey").alias("geolocation_zip_code_prefix"),
        text(-60.0 + 5.0 * nk + (ck % 7 - 3) * 0.25).alias("geolocation_lat"),
        text(-150.0 + 12.0 * nk + (ck % 5 - 2) * 0.25).alias("geolocation_lng"))
    translation = t("part").where(F.col("p_type") != "PROMO").select(
        native.alias("product_category_name"),
        F.concat(F.lower("p_type"), F.lit("_goods")).alias("product_category_name_english")
    ).distinct()
    return {"orders": orders, "items": items, "products": products, "customers": customers,
            "sellers": sellers, "geolocation": geolocation, "translation": translation}
