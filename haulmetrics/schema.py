"""Table schemas and the fixed values every stage agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# --- fixed values: canonical order columns, in output order ---------------
ORDER_COLUMNS = [
    "order_id", "order_date", "customer_id", "customer_segment",
    "product_id", "product_category", "quantity", "unit_price",
    "discount_rate", "weight_kg", "origin_warehouse_id", "origin_region",
    "destination_city", "destination_country", "destination_region",
    "destination_latitude", "destination_longitude", "distance_km",
    "carrier", "shipping_mode", "promised_delivery_days",
    "actual_delivery_days", "shipping_cost", "order_status", "delay_reason",
]

# --- fixed values: which canonical columns hold numbers -------------------
NUMERIC_COLUMNS = [
    "quantity", "unit_price", "discount_rate", "weight_kg",
    "distance_km", "shipping_cost", "promised_delivery_days",
    "actual_delivery_days", "destination_latitude", "destination_longitude",
]

# --- fixed values: identifiers and labels, always text --------------------
LABEL_COLUMNS = [
    "order_id", "customer_id", "product_id", "origin_warehouse_id",
    "carrier", "shipping_mode", "product_category", "order_status",
    "origin_region", "destination_city", "destination_country",
    "destination_region", "delay_reason", "customer_segment",
]

# --- fixed values: source headers accepted for each canonical column ------
# Compared after lower-casing and dropping everything but letters and digits.
HEADER_ALIASES = {
    "order_id": ["orderitemid", "orderid", "ordernumber", "id", "skuid", "sku"],
    "order_date": ["orderdate", "date", "orderdatedateorders", "shipdate"],
    "customer_id": ["customerid", "custid", "customer"],
    "customer_segment": ["customersegment", "segment", "customertype"],
    "product_id": ["productid", "productcardid", "itemid", "sku"],
    "product_category": ["productcategory", "categoryname", "category", "producttype"],
    "quantity": ["quantity", "orderitemquantity", "ordersquantity", "numberofproductssold",
                 "qty", "unitssold"],
    "unit_price": ["unitprice", "productprice", "price", "orderitemproductprice"],
    "discount_rate": ["discountrate", "orderitemdiscountrate", "discount"],
    "weight_kg": ["weightkg", "weight", "productweight", "shippingweight"],
    "origin_warehouse_id": ["originwarehouseid", "warehouseid", "departmentid",
                            "departmentname", "location", "originlocation"],
    "origin_region": ["originregion", "market", "region"],
    "destination_city": ["destinationcity", "ordercity", "customercity", "city"],
    "destination_country": ["destinationcountry", "ordercountry", "customercountry", "country"],
    "destination_region": ["destinationregion", "orderregion", "customerregion", "orderstate"],
    "destination_latitude": ["destinationlatitude", "latitude", "lat", "customerlat"],
    "destination_longitude": ["destinationlongitude", "longitude", "lon", "lng", "customerlong"],
    "distance_km": ["distancekm", "distance", "shippingdistance"],
    "carrier": ["carrier", "shippingcarrier", "shippingcarriers", "carriername"],
    "shipping_mode": ["shippingmode", "shipmode", "shippingtype", "transportationmodes"],
    "promised_delivery_days": ["promiseddeliverydays", "daysforshipmentscheduled",
                               "scheduledshippingdays", "promiseddays"],
    "actual_delivery_days": ["actualdeliverydays", "daysforshippingreal", "realshippingdays",
                             "shippingtimes", "actualdays"],
    "shipping_cost": ["shippingcost", "shippingcosts", "freightcost", "costs"],
    "order_status": ["orderstatus", "status"],
    "delay_reason": ["delayreason", "deliverystatus", "latedeliveryrisk", "reason"],
}

# --- fixed values: defaults for labels with missing entries ---------------
LABEL_DEFAULTS = {
    "origin_warehouse_id": "WH-001",
    "origin_region": "Unknown",
    "destination_city": "Unknown",
    "destination_country": "Unknown",
    "destination_region": "Unknown",
    "delay_reason": "None",
}

# --- fixed values: choices used when a source lacks a column entirely -----
CARRIERS = ["DHL Express", "FedEx", "UPS", "Maersk Line", "DB Schenker", "Local Courier Co"]
SHIPPING_MODES = ["Standard Class", "First Class", "Second Class", "Same Day"]
CUSTOMER_SEGMENTS = ["Consumer", "Corporate", "Home Office"]
DISCOUNT_RATES = [0.0, 0.05, 0.1, 0.15, 0.2]

# --- fixed values: warehouse capacity in units per day --------------------
WAREHOUSE_CAPACITY = [
    ("WH-001", "North America", 4200),
    ("WH-002", "North America", 3100),
    ("WH-003", "Europe", 3800),
    ("WH-004", "Europe", 2600),
    ("WH-005", "Asia Pacific", 5200),
    ("WH-006", "Asia Pacific", 3900),
    ("WH-007", "Latin America", 1800),
    ("WH-008", "Africa", 1200),
]
WAREHOUSE_SCHEMA = struct(warehouse_id=STRING, region=STRING, capacity_units_per_day=INT)

# --- fixed values: bins, (upper edge inclusive, label) --------------------
MODE_BY_PROMISED_DAYS = [(0, "Same Day"), (2, "First Class"), (5, "Second Class"),
                         (None, "Standard Class")]
DISTANCE_BINS = [(500, "Local"), (2000, "Regional"), (6000, "Long-Haul"),
                 (None, "International")]
SIZE_BINS = [(5, "Small"), (25, "Medium"), (100, "Large"), (None, "Bulk")]
DISTANCE_LABELS = [label for _, label in DISTANCE_BINS]
SIZE_LABELS = [label for _, label in SIZE_BINS]

# --- fixed values: the modelling table ------------------------------------
SPLIT_IDS = ["order_id", "customer_id", "order_date"]
SPLIT_FEATURES = [
    "quantity", "unit_price", "discount_rate", "weight_kg", "distance_km",
    "promised_delivery_days", "shipping_cost", "shipping_cost_per_unit",
    "route_efficiency_score", "carrier_performance_score", "seasonal_demand_index",
    "warehouse_utilization", "inventory_turnover", "reorder_risk_score",
    "carrier", "shipping_mode", "product_category", "customer_segment",
    "destination_region", "distance_category", "shipment_size_category", "order_status",
]
SPLIT_TARGETS = ["is_delayed", "delivery_delay"]

# --- fixed values: the derived feature columns ----------------------------
FEATURE_COLUMNS = [
    "delivery_delay", "is_delayed", "shipping_cost_per_unit", "route_efficiency_score",
    "carrier_performance_score", "seasonal_demand_index", "distance_category",
    "warehouse_utilization", "inventory_turnover", "reorder_risk_score",
    "shipment_size_category",
]

# --- fixed values: text that means "missing" in CSV input -----------------
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: the provenance labels and the milestone vocabulary -----
PRIMARY_SOURCE, SECOND_SOURCE = "dataco", "olist"
MILESTONES = [
    ("order_purchase_timestamp", "ORDER_PLACED"),
    ("order_approved_at", "PAYMENT_APPROVED"),
    ("order_delivered_carrier_date", "HANDED_TO_CARRIER"),
    ("order_delivered_customer_date", "DELIVERED"),
]

EVENT_COLUMNS = ["order_id", "carrier", "event_timestamp", "event_type", "location",
                 "delay_reason"]
EVENT_PAGE_SCHEMA = T.StructType([
    T.StructField("page", LONG),
    T.StructField("page_size", LONG),
    T.StructField("total_rows", LONG),
    T.StructField("results", T.ArrayType(struct(**{c: STRING for c in EVENT_COLUMNS}))),
])

# Column lists of the seven marketplace tables; dates named in MARKET_DATES.
MARKET_TABLES = {
    "orders": struct(
        order_id=STRING, customer_id=STRING, order_status=STRING,
        order_purchase_timestamp=STRING, order_approved_at=STRING,
        order_delivered_carrier_date=STRING, order_delivered_customer_date=STRING,
        order_estimated_delivery_date=STRING),
    "items": struct(order_id=STRING, order_item_id=STRING, product_id=STRING,
                    seller_id=STRING, price=STRING, freight_value=STRING),
    "products": struct(product_id=STRING, product_category_name=STRING,
                       product_weight_g=STRING),
    "customers": struct(customer_id=STRING, customer_unique_id=STRING,
                        customer_zip_code_prefix=STRING, customer_city=STRING,
                        customer_state=STRING),
    "sellers": struct(seller_id=STRING, seller_zip_code_prefix=STRING, seller_state=STRING),
    "geolocation": struct(geolocation_zip_code_prefix=STRING, geolocation_lat=STRING,
                          geolocation_lng=STRING),
    "translation": struct(product_category_name=STRING, product_category_name_english=STRING),
}
MARKET_DATES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
MARKET_NUMBERS = {
    "order_item_id": "int", "price": "double", "freight_value": "double",
    "product_weight_g": "double", "geolocation_lat": "double", "geolocation_lng": "double",
}
