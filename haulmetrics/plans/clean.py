"""Cleaning of orders and tracking events.

Order of steps: exact duplicates, dates, text, shipping mode, category,
coordinates, imputation, types. Every count and median is taken after the
filters before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from haulmetrics.functions.dates import EXTRA_FORMATS, infer_formats, parse_timestamp
from haulmetrics.functions.numeric import binned, plain_zeros, round_even
from haulmetrics.functions.text import strip, title
from haulmetrics.operators.impute import fill_from_groups
from haulmetrics.schema import MODE_BY_PROMISED_DAYS
from haulmetrics.session import new_path, stage

# Columns filled from group medians, with the columns that form the group.
IMPUTED = [
    ("actual_delivery_days", ["carrier", "shipping_mode"]),
    ("shipping_cost", ["shipping_mode"]),
    ("distance_km", ["destination_region"]),
    ("weight_kg", ["product_category"]),
]

#: Hashes of repeated rows that are broadcast at most, 8 bytes each.
REPEATED_ROWS = 4_000_000
#: Up to so many rows are folded in one exchange: there is nothing to save.
FEW_ROWS = 100


def drop_copies(df: DataFrame) -> DataFrame:
    """Exact-row duplicates removed; missing values compare equal.

    Only hashes and the rows that repeat travel, see ``counted_rows``; ``df`` should be a
    stored table.
    """
    return counted_rows(df).drop("__copies")


def nan_to_null(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def parse_order_dates(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS) -> DataFrame:
    """Text dates to timestamps; malformed ones become null.

    ``formats=None`` takes the forms that the column itself is written in, found in one
    pass over it.
    """
    if formats is None:
        formats = infer_formats(df, "order_date")
    return df.withColumn("order_date", parse_timestamp("order_date", formats))


def standardise_text(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "product_category": title(strip("product_category")),
        "carrier": strip("carrier"),
        "order_status": F.upper(strip("order_status")),
    })


def infer_shipping_mode(df: DataFrame) -> DataFrame:
    """Missing mode from the row's own promised days, else the standard one."""
    inferred = binned("promised_delivery_days", MODE_BY_PROMISED_DAYS)
    return df.withColumn("shipping_mode",
                         F.coalesce("shipping_mode", inferred, F.lit("Standard Class")))


def default_category(df: DataFrame) -> DataFrame:
    return df.withColumn("product_category", F.coalesce("product_category", F.lit("Unknown")))


def valid_coordinates() -> Column:
    """True only for a known position on the globe."""
    inside = (F.col("destination_latitude").between(-90, 90)
              & F.col("destination_longitude").between(-180, 180))
    return F.coalesce(inside, F.lit(False))


def convert_types(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "quantity": F.col("quantity").try_cast("bigint"),
        "actual_delivery_days": round_even("actual_delivery_days").try_cast("bigint"),
        "promised_delivery_days": F.col("promised_delivery_days").try_cast("bigint"),
        "unit_price": round_even("unit_price", 2),
        "shipping_cost": round_even("shipping_cost", 2),
    })


def counted_rows(df: DataFrame, *, write: bool = True,
                 broadcast_rows: int = REPEATED_ROWS) -> DataFrame:
    """Distinct rows with the number of their copies, in ``__copies``.

    Rows that share their hash with no other row have no copy and stay where they are; only
    the hashes travel, and whole rows of the hashes that repeat. Beyond ``broadcast_rows``
    such hashes all rows travel, folded first. ``df`` is read three times and should be a
    stored table; the repeated hashes are staged unless ``write`` is off.
    """
    columns = df.columns
    hashed = df.withColumn("__hash", F.xxhash64(*columns))
    repeated = (hashed.groupBy("__hash").agg(F.count("*").alias("__copies"))
                .where("__copies > 1").select("__hash"))
    if write:
        repeated = stage(repeated, "repeated")
    if repeated.count() > broadcast_rows:
        return df.groupBy(*columns).agg(F.count("*").alias("__copies"))
    repeated = F.broadcast(repeated)
    alone = plain_zeros(hashed.join(repeated, "__hash", "left_anti").select(
        *columns, F.lit(1).cast("bigint").alias("__copies")))
    copied = (hashed.join(repeated, "__hash", "left_semi").groupBy(*columns)
              .agg(F.count("*").alias("__copies")))
    return alone.unionByName(copied)


def folded(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS,
           keep_text: bool = False, write: bool = True) -> DataFrame:
    """Distinct rows with the number of their copies, dates parsed.

    ``keep_text`` keeps the text of the date beside it.
    """
    if formats is None:
        formats = infer_formats(df, "order_date")
    if len(df.select(F.lit(1)).take(FEW_ROWS + 1)) > FEW_ROWS:
        rows = counted_rows(df, write=write)
    else:
        rows = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    rows = nan_to_null(rows)
    if keep_text:
        rows = rows.withColumn("__date_text", F.col("order_date"))
    return parse_order_dates(rows, formats)


def standardised(dated: DataFrame) -> DataFrame:
    """Text, shipping mode and category, for rows with a date."""
    return default_category(infer_shipping_mode(standardise_text(dated)))


def counters() -> list[Column]:
    """Aggregates over ``folded`` rows for the cleaning report."""
    dated = F.col("order_date").isNotNull()
    valid = dated & valid_coordinates()

    def tally(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    copies = F.col("__copies")
    found = [
        F.coalesce(F.sum(copies), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicates_removed"),
        tally(~dated).alias("invalid_dates_dropped"),
        tally(dated & F.col("shipping_mode").isNull()).alias("missing_shipping_mode_before"),
        tally(dated & ~valid_coordinates()).alias("invalid_coordinates_removed"),
    ]
    found += [tally(valid & F.col(c).isNull()).alias(f"missing_{c}_before") for c, _ in IMPUTED]
    return [*found, tally(valid).alias("output_rows")]


def _report_row(df: DataFrame, found: dict[str, int]) -> DataFrame:
    found = {name: int(n) for name, n in found.items()}
    found["rows_dropped_total"] = found["input_rows"] - found["output_rows"]
    return df.sparkSession.createDataFrame(
        [tuple(found.values())], ", ".join(f"{name} bigint" for name in found))


def located(df: DataFrame,
            formats: Sequence[str] | None = EXTRA_FORMATS) -> tuple[DataFrame, DataFrame]:
    """Rows that survive cleaning, before imputation, as a staged table, and the counters.

    The counters are observed while the table is written, so nothing runs twice.
    """
    seen = Observation("clean")
    rows = folded(df, formats).observe(seen, *counters()).drop("__copies")
    table = stage(standardised(rows.where("order_date is not null")).where(valid_coordinates()),
                  "located")
    return table, _report_row(df, seen.get)


#: Why a row is rejected, in the order of the steps.
REASONS = {"dates": "no readable order date", "coordinates": "position missing or off the globe"}
KEPT = "kept"


def routed(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS,
           ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like ``located``, and the rejected rows.

    One pass writes every distinct row to the part of its outcome. A rejected row keeps the
    values it came with: the columns of ``df``, the step and reason, and its copies.
    """
    seen = Observation("route")
    outcome = (F.when(F.col("order_date").isNull(), "dates")
               .when(~valid_coordinates(), "coordinates").otherwise(KEPT))
    rows = folded(df, formats, keep_text=True).observe(seen, *counters())
    rows = rows.withColumn("__outcome", outcome)
    spark = df.sparkSession
    path = new_path(spark, "routed")
    rows.write.partitionBy("__outcome").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    table = standardised(stored.where(F.col("__outcome") == KEPT)
                         .drop("__outcome", "__copies", "__date_text"))
    reasons = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    rejected = (stored.where(F.col("__outcome") != KEPT)
                .withColumn("order_date", F.col("__date_text"))
                .select(F.col("__outcome").alias("step"), reasons[F.col("__outcome")].alias("reason"),
                        F.col("__copies").alias("copies"), *df.columns))
    return table, _report_row(df, seen.get), rejected


def clean_with_report(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS,
                      **options) -> tuple[DataFrame, DataFrame]:
    """The cleaned orders table and one row of counters, from one pass over ``df``."""
    table, report = located(df, formats)
    return convert_types(fill_from_groups(table, IMPUTED, **options)), report


def clean_with_rejects(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS,
                       **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cleaned orders table, the counters and the rejected rows, from one pass."""
    table, report, rejected = routed(df, formats)
    return convert_types(fill_from_groups(table, IMPUTED, **options)), report, rejected


def clean_orders(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS, **options) -> DataFrame:
    """The cleaned orders table."""
    return clean_with_report(df, formats, **options)[0]


def clean_report(df: DataFrame, formats: Sequence[str] | None = EXTRA_FORMATS) -> DataFrame:
    """One row of counters for ``clean_orders``; nothing is written."""
    found = folded(df, formats, write=False).agg(*counters())
    return found.withColumn("rows_dropped_total", F.col("input_rows") - F.col("output_rows"))


def clean_events(df: DataFrame) -> DataFrame:
    """Tracking events: duplicates and bad times dropped, event type standardised."""
    return (drop_copies(df)
            .withColumn("event_timestamp", parse_timestamp("event_timestamp"))
            .where("event_timestamp is not null")
            .withColumn("event_type", F.upper(strip("event_type"))))
