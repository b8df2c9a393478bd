"""Map an order feed with foreign headers onto the canonical schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.functions.dates import EXTRA_FORMATS, infer_formats, parse_timestamp
from haulmetrics.functions.hashing import choice, uniform, uniform_int, uniform_real
from haulmetrics.functions.numeric import round_even, to_number
from haulmetrics.functions.text import digits_only, header_key
from haulmetrics.operators.numbering import number_file_rows, number_rows
from haulmetrics.plans.clean import counted_rows
from haulmetrics.schema import (CARRIERS, CUSTOMER_SEGMENTS, DISCOUNT_RATES, HEADER_ALIASES,
                                LABEL_DEFAULTS, NUMERIC_COLUMNS, ORDER_COLUMNS, SHIPPING_MODES)


@dataclass
class HeaderMatch:
    matched: dict[str, str] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)


def match_headers(headers: list[str]) -> HeaderMatch:
    """For each canonical column, the source header of its first alias present."""
    lookup = {header_key(h): h for h in headers}
    result = HeaderMatch()
    for target in ORDER_COLUMNS:
        keys = [header_key(target), *HEADER_ALIASES[target]]
        source = next((lookup[k] for k in keys if k in lookup), None)
        if source is None:
            result.missing.append(target)
        else:
            result.matched[target] = source
    return result


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def select_canonical(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 25 canonical columns as text, absent ones null, and those of ``keep`` as they are."""
    found = match_headers(df.columns).matched
    return df.select(*[
        (_quoted(found[c]) if c in found else F.lit(None)).cast("string").alias(c)
        for c in ORDER_COLUMNS], *keep)


def sequence_id(number: Column, prefix: str = "ORD-") -> Column:
    return F.format_string(f"{prefix}%07d", number)


def duplicate_ids(df: DataFrame, column: str = "order_id") -> DataFrame:
    """Rows whose id already occurred: all rows less the distinct ids.

    A missing id counts as one more value, as it would as text.
    """
    text = F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))
    return df.agg((F.count("*") - F.count_distinct(text)).alias("duplicates"))


def id_expression(df: DataFrame) -> tuple[Column, bool]:
    """Ids of the form ORD-<digits>, and whether they need ``row_number``.

    Without source ids, or with any repeated one, all rows are numbered, and
    the ids are unique. Otherwise the digits of the source id are kept, and rows
    whose id has no digits get their row number; source ids that differ in
    other signs only ("A-1", "B-1") then share an id, which ``duplicate_ids``
    counts.
    """
    facts = df.agg(F.count("*").alias("total"), F.count("order_id").alias("known"),
                   F.count(F.when(F.length(digits_only("order_id")) > 0, 1)).alias("digits")).first()
    repeated = facts["total"] - facts["known"] > 1
    if facts["known"] and not repeated:
        # the hashes of all ids are counted, and the ids themselves where a hash repeats
        ids = counted_rows(df.where("order_id is not null").select("order_id"))
        repeated = not ids.where("__copies > 1").isEmpty()
    if facts["known"] and not repeated and facts["digits"] == facts["total"]:
        return F.concat(F.lit("ORD-"), digits_only("order_id")), False
    if not facts["known"] or repeated:
        return sequence_id(F.col("row_number")), True
    digits = F.coalesce(digits_only("order_id"), F.lit(""))
    kept = F.when(F.length(digits) > 0, digits).otherwise(F.col("row_number").cast("string"))
    return F.concat(F.lit("ORD-"), kept), True


def cycled(prefix: str, modulo: int, width: int) -> Column:
    """Stand-in ids cycling through ``modulo`` values by row number."""
    return F.format_string(f"{prefix}%0{width}d", (F.col("row_number") - 1) % modulo)


def assign_order_ids(df: DataFrame) -> DataFrame:
    made, numbered = id_expression(df)
    rows = number_rows(df) if numbered else df
    return rows.withColumn("order_id", made).drop("row_number")


def cycle_ids(df: DataFrame, column: str, prefix: str, modulo: int, width: int) -> DataFrame:
    return number_rows(df).withColumn(column, cycled(prefix, modulo, width)).drop("row_number")


def coerce_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in NUMERIC_COLUMNS})


def fill_expressions(seed: int = 42) -> list[tuple[str, Column]]:
    """What a wholly absent column is filled with, in order of dependence.

    Draws depend on the order id, the column and the seed only, so they are
    the same for any partitioning.
    """
    key = "order_id"
    return [
        ("quantity", uniform_int(key, "quantity", 1, 50, seed).cast("double")),
        ("unit_price", round_even(uniform_real(key, "unit_price", 5, 500, seed), 2)),
        ("discount_rate", choice(key, "discount_rate", DISCOUNT_RATES, seed)),
        ("weight_kg", round_even(F.col("quantity")
                                 * uniform_real(key, "weight_kg", 0.1, 3.0, seed), 3)),
        ("distance_km", round_even(uniform_real(key, "distance_km", 10, 12000, seed), 1)),
        ("shipping_cost", round_even(F.col("distance_km") * 0.05 + F.col("weight_kg") * 1.5, 2)),
        ("promised_delivery_days",
         uniform_int(key, "promised_delivery_days", 2, 12, seed).cast("double")),
        ("actual_delivery_days",
         F.when(F.col("promised_delivery_days").isNotNull(), F.greatest(
             F.col("promised_delivery_days")
             + uniform_int(key, "actual_delivery_days", -2, 5, seed), F.lit(1.0)))),
        ("destination_latitude",
         round_even(uniform_real(key, "destination_latitude", -60, 70, seed), 6)),
        ("destination_longitude",
         round_even(uniform_real(key, "destination_longitude", -170, 175, seed), 6)),
        ("carrier", choice(key, "carrier", CARRIERS, seed)),
        ("shipping_mode", choice(key, "shipping_mode", SHIPPING_MODES, seed)),
        ("order_status", F.lit("DELIVERED")),
        ("product_category", F.lit("Unknown")),
        ("customer_segment", choice(key, "customer_segment", CUSTOMER_SEGMENTS, seed)),
    ]


def fill_absent(df: DataFrame, absent: set[str], seed: int = 42) -> DataFrame:
    """Fill the columns named in ``absent``; others are left alone."""
    for column, value in fill_expressions(seed):
        if column in absent:
            df = df.withColumn(column, value)
    return df


def default_labels(df: DataFrame) -> DataFrame:
    """Six labels get a default wherever they are missing."""
    return df.withColumns({c: F.coalesce(c, F.lit(d)) for c, d in LABEL_DEFAULTS.items()})


def known_counts(df: DataFrame) -> dict[str, int]:
    """Non-missing values per column after parsing, in one aggregation (one row)."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()


def map_to_schema(df: DataFrame, seed: int = 42,
                  formats: Sequence[str] | None = EXTRA_FORMATS,
                  order: str = "content") -> DataFrame:
    """The whole mapping. ``df`` should be a source or staged table: it is
    summarised once for ids and once for absent columns before the result is
    planned. ``formats=None`` takes the date forms of the feed itself.
    Rows are numbered by ``order``: of their content, the same however the feed is stored,
    or "file", that of a Parquet table's files, which shuffles no row.
    """
    canonical = select_canonical(df)
    if formats is None:
        formats = infer_formats(canonical, "order_date")
    # Dates count as present when there is any text, even if none of it parses.
    known = known_counts(coerce_numbers(canonical))
    if not known["order_date"]:
        raise ValueError("no usable order date column in the source; add its header to "
                         "HEADER_ALIASES['order_date']")
    made, numbered = id_expression(canonical)
    fills = {"order_id": made}
    for column, prefix, modulo, width in [("customer_id", "CUST-", 20000, 5),
                                          ("product_id", "PROD-", 500, 4)]:
        if not known[column]:
            fills[column] = cycled(prefix, modulo, width)
    # one numbering serves all three ids
    if not numbered and len(fills) == 1:
        rows = canonical
    elif order == "file":
        rows = select_canonical(number_file_rows(df, name="__number"), ["__number"])
        rows = rows.withColumnRenamed("__number", "row_number")
    else:
        rows = number_rows(canonical)
    out = rows.withColumns(fills).drop("row_number")
    out = coerce_numbers(out).withColumn("order_date", parse_timestamp("order_date", formats))
    absent = {c for c, n in known.items() if n == 0}
    return default_labels(fill_absent(out, absent, seed)).select(*ORDER_COLUMNS)
