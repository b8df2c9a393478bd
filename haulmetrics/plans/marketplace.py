"""Seven-table marketplace feed: star join, mapping and delivery milestones."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.functions.dates import whole_days
from haulmetrics.functions.numeric import haversine_km, round_even
from haulmetrics.functions.text import packed, prefixed, title, unpacked
from haulmetrics.operators.attach import attach, fits
from haulmetrics.operators.numbering import number_rows
from haulmetrics.schema import MILESTONES, ORDER_COLUMNS
from haulmetrics.session import stage


def centroids(geolocation: DataFrame) -> DataFrame:
    """One point per postcode prefix: the mean of its positions."""
    return geolocation.groupBy("geolocation_zip_code_prefix").agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng"))


def near_point(df: DataFrame, points: DataFrame, zip_column: str, suffix: str) -> DataFrame:
    """Left join of the centroid of one postcode column, under suffixed names."""
    side = points.select(F.col("geolocation_zip_code_prefix").alias(zip_column),
                         F.col("lat").alias(f"geolocation_lat_{suffix}"),
                         F.col("lng").alias(f"geolocation_lng_{suffix}"))
    return df.join(side, zip_column, "left")


#: Long keys of the tables, shuffled as bytes.
KEYS = ("order_id", "customer_id", "customer_unique_id", "product_id", "seller_id")


def _with_keys(df: DataFrame, change: Callable[[str], Column], kind: str) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: change(c) for c in KEYS if kinds.get(c) == kind})


def join_tables(tables: dict[str, DataFrame], *, staged: bool = False) -> DataFrame:
    """Items with their order, product, customer, seller, translation and both points.

    Plain equi-joins: table sizes known from the files decide which side is
    broadcast, and skewed partitions are split at run time. The centroids, sellers and
    products are staged so that their size is known too; otherwise joins with them
    would shuffle the items. Tables that ``fits`` allows are broadcast and joined after the
    orders, so that no shuffle carries their columns; larger ones are joined to the items
    before the wide orders. With ``staged`` both sides are then stored, so that the files of
    one shuffle of the items are gone when the next one is written. Keys are
    joined as bytes, as keys in hex, which shuffles do not compress, take half.
    """
    tables = {name: _with_keys(df, packed, "string") for name, df in tables.items()}
    points = stage(centroids(tables["geolocation"]), "centroids")
    # customers have one row per order, so they are joined before the items fan out
    orders = near_point(tables["orders"].join(tables["customers"], "customer_id", "left"),
                        points, "customer_zip_code_prefix", "cust")
    sellers = stage(near_point(tables["sellers"], points, "seller_zip_code_prefix", "sell"),
                    "sellers")
    products, translation = stage(tables["products"], "products"), tables["translation"]
    translation = stage(translation, "translation")
    translated = products.join(translation, "product_category_name", "left")
    columns = (tables["items"].join(orders, "order_id").join(translated, "product_id", "left")
               .join(sellers, "seller_id", "left").columns)

    def add_sellers(df: DataFrame, small: bool) -> DataFrame:
        return df.join(F.broadcast(sellers) if small else sellers, "seller_id", "left")

    def add_products(df: DataFrame, small: bool) -> DataFrame:
        if not small:
            return df.join(translated, "product_id", "left")
        # the names of categories are looked up after, so that only keys of them are broadcast
        return (df.join(F.broadcast(products), "product_id", "left")
                .join(translation, "product_category_name", "left"))

    steps = [(add_products, fits(products)), (add_sellers, fits(sellers))]
    joined = tables["items"]
    for add, small in steps:
        joined = joined if small else add(joined, small)
    if staged and not all(small for _, small in steps):
        joined, orders = stage(joined, "items"), stage(orders, "item_orders")
    joined = joined.join(orders, "order_id", "inner")
    for add, small in steps:
        joined = add(joined, small) if small else joined
    return _with_keys(joined.select(*columns), unpacked, "binary")


def category_label() -> Column:
    name = F.coalesce("product_category_name_english", "product_category_name")
    label = title(F.replace(name, F.lit("_"), F.lit(" ")))
    return F.nullif(label, F.lit("Nan"))


def buyer_segment(df: DataFrame) -> DataFrame:
    """Returning for customers seen on more than one item row, else New.

    Missing customer ids are one group, as they compare equal to each other. The
    customers of the smaller segment are looked up, the others are the rest.
    """
    counts = stage(df.groupBy("customer_unique_id").agg(F.count("*").alias("n")), "buyers")
    again, once = counts.agg(F.count_if(F.col("n") > 1), F.count_if(F.col("n") == 1)).first()
    listed, rest = ("Returning", "New") if again <= once else ("New", "Returning")
    wanted = counts.where("n > 1" if listed == "Returning" else "n = 1")
    rows = attach(df, wanted.withColumn("customer_segment", F.lit(listed)),
                  ["customer_unique_id"], weight="n", null_safe=True)
    return rows.withColumn("customer_segment", F.coalesce("customer_segment", F.lit(rest)))


def distance() -> Column:
    return round_even(haversine_km("geolocation_lat_sell", "geolocation_lng_sell",
                                   "geolocation_lat_cust", "geolocation_lng_cust"), 2)


def promised_days() -> Column:
    return whole_days("order_purchase_timestamp", "order_estimated_delivery_date")


def actual_days() -> Column:
    return whole_days("order_purchase_timestamp", "order_delivered_customer_date")


def delay_reason() -> Column:
    return (F.when(actual_days().isNull(), "Not delivered")
            .when(actual_days() > promised_days(), "Late delivery")
            .otherwise("None"))


ITEM_KEY = ("order_id", "order_item_id", "product_id", "seller_id")


# Signs of a key that its canonical id keeps; None keeps the whole key.
KEY_LENGTHS = {"customer_id": 12, "product_id": 12, "origin_warehouse_id": 8, "carrier": 6}
KEY_SOURCES = {"customer_id": "customer_id", "product_id": "product_id",
               "origin_warehouse_id": "seller_id", "carrier": "seller_id"}


def merged_keys(joined: DataFrame,
                lengths: Mapping[str, int | None] = KEY_LENGTHS) -> DataFrame:
    """For each canonical id: its length, the distinct keys, and how many of them share
    their id with another key because of the cut.

    The distinct keys of all columns come from one pass, which reads only the keys, so
    ``joined`` need not be a stored table.
    """
    sources = sorted({KEY_SOURCES[column] for column in lengths})
    pairs = F.array(*[F.struct(F.lit(s).alias("source"), packed(s).alias("key")) for s in sources])
    keys = stage(joined.select(F.explode(pairs).alias("p")).select("p.*")
                 .where("key is not null").distinct(), "keys")
    parts = []
    for column, length in lengths.items():
        ids = (keys.where(F.col("source") == KEY_SOURCES[column])
               .groupBy(prefixed("", unpacked("key"), length)).agg(F.count("*").alias("n")))
        parts.append(ids.agg(
            F.lit(column).alias("column"), F.lit(length).cast("int").alias("length"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("keys"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("merged")))
    return reduce(DataFrame.unionByName, parts)


def map_to_schema(joined: DataFrame,
                  lengths: Mapping[str, int | None] = KEY_LENGTHS) -> DataFrame:
    """Canonical columns, with the four milestone times kept alongside.

    ``joined`` should be a staged table. ``lengths`` are the signs that ids keep of their
    keys, None for all; ``merged_keys`` counts what a cut merges. Rows are mapped before
    they are numbered, and the shuffle for that carries what a query uses of them.
    """
    lengths = {**KEY_LENGTHS, **lengths}
    mapped = {
        "customer_id": prefixed("CUST-", "customer_id", lengths["customer_id"]),
        "customer_segment": F.col("customer_segment"),
        "product_id": prefixed("PROD-", "product_id", lengths["product_id"]),
        "product_category": category_label(),
        "quantity": F.col("order_item_id"),
        "unit_price": F.col("price"),
        "weight_kg": F.col("product_weight_g") / 1000.0,
        "origin_warehouse_id": prefixed("SELLER-", "seller_id", lengths["origin_warehouse_id"]),
        "origin_region": F.col("seller_state"),
        "destination_city": title("customer_city"),
        "destination_region": F.col("customer_state"),
        "destination_latitude": F.col("geolocation_lat_cust"),
        "destination_longitude": F.col("geolocation_lng_cust"),
        "distance_km": distance(),
        "carrier": prefixed("Seller-", "seller_id", lengths["carrier"]),
        "shipping_cost": F.col("freight_value"),
        "order_status": F.upper("order_status"),
    }
    times = [*[c for c, _ in MILESTONES], "order_estimated_delivery_date"]
    # items that share all keys follow their amounts
    rows = number_rows(buyer_segment(joined), ITEM_KEY, ties=["price", "freight_value"], keep=[
        *[value.alias(c) for c, value in mapped.items()], *[F.col(c) for c in times]])
    canonical = {c: F.col(c) for c in mapped} | {
        "order_id": F.format_string("ORD-OLIST-%07d", F.col("row_number")),
        "order_date": F.col("order_purchase_timestamp"),
        "discount_rate": F.lit(0.0),
        "destination_country": F.lit("Brazil"),
        "shipping_mode": F.lit(None).cast("string"),
        "promised_delivery_days": promised_days(),
        "actual_delivery_days": actual_days(),
        "delay_reason": delay_reason(),
    }
    return rows.select(*[canonical[c].alias(c) for c in ORDER_COLUMNS],
                       *[F.col(c) for c, _ in MILESTONES])


def milestone_events(mapped: DataFrame) -> DataFrame:
    """One row per recorded milestone; only a late delivery carries its reason."""
    pairs = F.array(*[F.struct(F.lit(kind).alias("event_type"),
                               F.col(column).alias("event_timestamp"))
                      for column, kind in MILESTONES])
    known = F.filter(pairs, lambda p: p["event_timestamp"].isNotNull())
    late = (F.col("event_type") == "DELIVERED") & (F.col("delay_reason") == "Late delivery")
    return (mapped.select("order_id", "carrier", F.col("destination_city").alias("location"),
                          "delay_reason", F.inline(known))
            .withColumn("delay_reason", F.when(late, "Late delivery").otherwise("None"))
            .select("order_id", "carrier", "event_timestamp", "event_type", "location",
                    "delay_reason"))


def ordered_events(events: DataFrame) -> DataFrame:
    return events.orderBy("order_id", "event_timestamp", "event_type")
