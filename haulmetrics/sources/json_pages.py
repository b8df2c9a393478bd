"""Carrier data landed as JSON: pages of tracking events, rates by carrier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.operators.numbering import number_rows
from haulmetrics.schema import EVENT_COLUMNS, EVENT_PAGE_SCHEMA

PAGE_SIZE = 500


def read_pages(spark: SparkSession, path: str, document_per_file: bool = False) -> DataFrame:
    """Landed page objects, one per line or one per file."""
    reader = spark.read.schema(EVENT_PAGE_SCHEMA).option("multiLine", document_per_file)
    return reader.json(path)


def page_totals(pages: DataFrame) -> DataFrame:
    """Rows received and announced, pages received and announced, one row."""
    return pages.agg(F.coalesce(F.sum(F.size("results")), F.lit(0)).alias("received"),
                     F.coalesce(F.max("total_rows"), F.lit(0)).alias("announced"),
                     F.count_distinct("page").alias("pages"),
                     F.coalesce(F.max(F.ceil(F.col("total_rows") / F.col("page_size"))), F.lit(0))
                     .alias("announced_pages"))


def extract_events(spark: SparkSession, path: str, document_per_file: bool = False) -> DataFrame:
    """All events of all pages; an error when pages are missing."""
    pages = read_pages(spark, path, document_per_file)
    totals = page_totals(pages).first()
    if totals["received"] < totals["announced"] or totals["pages"] < totals["announced_pages"]:
        raise ValueError(f"received {totals['received']} of {totals['announced']} events, "
                         f"{totals['pages']} of {totals['announced_pages']} pages")
    return pages.select(F.inline("results"))


def to_pages(events: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Events as page objects; a page holds ``page_size`` rows at most."""
    text = events.select(*[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS])
    total = text.agg(F.count("*")).scalar()
    numbered = number_rows(text, start=0)
    return (numbered.groupBy((F.floor(F.col("row_number") / page_size) + 1).alias("page"))
            .agg(F.collect_list(F.struct(*EVENT_COLUMNS)).alias("results"))
            .select("page", F.lit(page_size).cast("bigint").alias("page_size"),
                    total.alias("total_rows"), "results"))


def explode_rates(df: DataFrame, column: str, name: str = "carrier",
                  value: str = "api_on_time_rate", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON objects of name -> number as (name, number) rows."""
    parsed = F.from_json(F.col(column), "map<string,double>")
    return df.select(*keep, F.explode(parsed).alias(name, value))
