"""CSV feeds."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.functions.dates import parse_timestamp
from haulmetrics.functions.numeric import to_number
from haulmetrics.schema import (LABEL_COLUMNS, MARKET_DATES, MARKET_NUMBERS, MARKET_TABLES,
                                MISSING_TOKENS, NUMERIC_COLUMNS, ORDER_COLUMNS, PRIMARY_SOURCE,
                                SECOND_SOURCE, STRING)
from haulmetrics.sources.quoted import lines, read_records
from haulmetrics.sources.tables import path_exists


def known_text(column: str) -> Column:
    """The text, or null where it is one of the usual words for "missing"."""
    return F.when(~F.col(column).isin(MISSING_TOKENS), F.col(column))


def read_csv(spark: SparkSession, path: str, columns: Iterable[str] | None = None,
             keep_tokens: Iterable[str] = ("delay_reason",), *, optional: Iterable[str] = (),
             multi_line: bool = False, check_quotes: bool = True) -> DataFrame:
    """CSV with header as text columns, missing-value words mapped to null.

    Columns are found by their header, whatever their order; others are left
    out where ``columns`` are given. One of them that the file lacks is an
    error, or null if it is ``optional``. Undecodable bytes become the
    replacement character. In the ``keep_tokens`` columns a word such as
    "None" is a value.

    Files are read in splits. A scan up to the first line with an odd number
    of quotes tells whether any record goes on over a quoted line break; if
    so, ``read_records`` puts records together across lines and blocks.
    ``check_quotes=False`` saves the scan for files known to have no such
    break; ``multi_line`` reads each file in one task instead.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
    df = reader.option("multiLine", multi_line).csv(path)
    if check_quotes and not multi_line and not torn_records(spark, path).isEmpty():
        df = read_records(spark, path, df.columns)
    wanted, optional = list(columns or df.columns), set(optional)
    if lacking := [c for c in wanted if c not in df.columns and c not in optional]:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    keep = set(keep_tokens)

    def text(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("string")
        quoted = "`" + name.replace("`", "``") + "`"
        return F.col(quoted) if name in keep else known_text(quoted)

    return df.select(*[text(c).alias(c) for c in wanted])


def torn_records(spark: SparkSession, path: str) -> DataFrame:
    """Lines with an odd number of quotes: a quoted value goes on in the next line."""
    return lines(spark, path).where("odd").select("value")


def labels_to_text(df: DataFrame) -> DataFrame:
    """Identifier and label columns as text, whichever of them are present."""
    return df.withColumns({c: F.col(c).cast("string") for c in LABEL_COLUMNS if c in df.columns})


def typed_orders(df: DataFrame) -> DataFrame:
    return labels_to_text(df).withColumns(
        {c: to_number(c) for c in NUMERIC_COLUMNS if c in df.columns})


def stack(feeds: Iterable[DataFrame]) -> DataFrame:
    """Feeds on top of each other by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def extract_orders(spark: SparkSession, path: str, second_path: str | None = None) -> DataFrame:
    """The canonical feed and, if its file exists, the second one, with provenance."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    feeds = [(path, PRIMARY_SOURCE)]
    if second_path and path_exists(spark, second_path):
        feeds.append((second_path, SECOND_SOURCE))
    return stack([typed_orders(read_csv(spark, p)).withColumn("source_system", F.lit(name))
                  for p, name in feeds])


def read_order_feed(spark: SparkSession, path: str) -> DataFrame:
    """One canonical feed: its 25 columns by name."""
    return typed_orders(read_csv(spark, path, ORDER_COLUMNS))


def typed_market(df: DataFrame) -> DataFrame:
    """Dates and numbers of a marketplace table, bad text to null."""
    dates = {c: parse_timestamp(c) for c in df.columns if c in MARKET_DATES}
    numbers = {c: to_number(c).cast(MARKET_NUMBERS[c]) for c in df.columns if c in MARKET_NUMBERS}
    return df.withColumns({**dates, **numbers})


def read_market_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return typed_market(read_csv(spark, f"{folder}/{name}", MARKET_TABLES[name].names))


def read_market(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seven tables, one reader each."""
    return {name: read_market_table(spark, folder, name) for name in MARKET_TABLES}
