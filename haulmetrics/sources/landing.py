"""Pages of tracking events taken over as they land, each once.

A folder of page objects is read as a stream: every run takes the files that came since
the last one and stops. Pages are told apart by their number; the first copy of a page is
taken, others are dropped by the stream's state, whether they come in the same run or
later, in order or not. Pages without a number are told apart by their content. The file
sink writes each batch once, so a run that failed half-way is simply started again.

Kept under ``store``: ``pages`` (the pages with file, digest and number of rows) and
``checkpoint`` (files seen, and the keys of pages). Both belong on a shared file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.schema import EVENT_PAGE_SCHEMA
from haulmetrics.session import configure
from haulmetrics.sources.tables import path_exists

#: Batches of one run whose figures are kept, so that the counts of a run are whole.
KEPT_PROGRESS = 1_000_000
RETENTION = "spark.sql.streaming.numRecentProgressUpdates"

LEDGER = ["page", "page_size", "total_rows", "n_rows", "digest", "file"]


def land_pages(spark: SparkSession, inbox: str, store: str, *, document_per_file: bool = False,
               files_per_batch: int = 1000) -> dict[str, int]:
    """Take what landed in ``inbox`` since the last run: pages read, taken and repeated."""
    reader = (configure(spark).readStream.schema(EVENT_PAGE_SCHEMA)
              .option("multiLine", document_per_file)
              .option("maxFilesPerTrigger", files_per_batch))
    digest = F.sha2(F.to_json(F.struct("results")), 256)
    pages = (reader.json(inbox)
             .select("*", F.coalesce(F.size("results"), F.lit(0)).alias("n_rows"),
                     digest.alias("digest"), F.col("_metadata.file_path").alias("file"))
             .withColumn("page_key", F.coalesce(F.col("page").cast("string"), "digest"))
             .dropDuplicates(["page_key"]))
    before = spark.conf.get(RETENTION)
    spark.conf.set(RETENTION, KEPT_PROGRESS)
    try:
        run = (pages.writeStream.format("parquet").option("path", f"{store}/pages")
               .option("checkpointLocation", f"{store}/checkpoint")
               .outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set(RETENTION, before)
    run.awaitTermination()
    found = {"read": 0, "repeated": 0}
    for progress in run.recentProgress:
        found["read"] += progress.numInputRows
        for state in progress.stateOperators:
            found["repeated"] += int(state.customMetrics.get("numDroppedDuplicateRows", 0))
    return {**found, "taken": found["read"] - found["repeated"]}


def landed_pages(spark: SparkSession, store: str) -> DataFrame:
    """The pages taken so far."""
    return spark.read.parquet(f"{store}/pages")


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """One row per page taken: what it announced and held, and the file it came in."""
    return landed_pages(spark, store).select(*LEDGER)


def progress(pages: DataFrame) -> DataFrame:
    """One row: rows and pages received and announced, and whether all are there."""
    announced = F.coalesce(F.max("total_rows"), F.lit(0))
    due = F.coalesce(F.max(F.ceil(F.col("total_rows") / F.col("page_size"))), F.lit(0))
    return (pages.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("received"),
                      announced.alias("announced"), F.count("*").alias("pages"),
                      due.alias("announced_pages"))
            .withColumn("complete", (F.col("received") >= F.col("announced"))
                        & (F.col("pages") >= F.col("announced_pages"))))


def missing_pages(pages: DataFrame) -> DataFrame:
    """Stretches of page numbers not there yet: ``first`` and ``last`` of each.

    Numbers are grouped in blocks of 65,536, so no task sees all of them; a stretch over
    the edge of a block is given as two.
    """
    block = 1 << 16
    due = pages.agg(F.coalesce(F.max(F.greatest(
        F.col("page"), F.ceil(F.col("total_rows") / F.col("page_size")))), F.lit(0)).alias("due"))
    have = (pages.where("page > 0").select("page").distinct()
            .groupBy(F.floor((F.col("page") - 1) / block).alias("block"))
            .agg(F.array_sort(F.collect_list("page")).alias("pages")))
    blocks = due.where("due > 0").select(
        "due", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                    F.floor((F.col("due") - 1) / block))).alias("block"))
    low = F.col("block") * block
    high = F.least(low + block, F.col("due"))
    edges = F.concat(F.array(low), F.coalesce("pages", F.array().cast("array<bigint>")),
                     F.array(high + 1))
    gaps = F.filter(F.transform(F.sequence(F.lit(1), F.size("edges") - 1), lambda i: F.struct(
        (F.element_at("edges", i) + 1).alias("first"),
        (F.element_at("edges", i + 1) - 1).alias("last"))), lambda g: g["first"] <= g["last"])
    return (blocks.join(have, "block", "left").withColumn("edges", edges)
            .select(F.inline(gaps)))


def landed_events(spark: SparkSession, store: str) -> DataFrame:
    """All events of the pages taken; an error while pages are missing."""
    if not path_exists(spark, f"{store}/pages"):
        raise FileNotFoundError(f"{store}: nothing has landed")
    pages = landed_pages(spark, store)
    state = progress(pages).first()
    if not state["complete"]:
        raise ValueError(f"received {state['received']} of {state['announced']} events, "
                         f"{state['pages']} of {state['announced_pages']} pages")
    return pages.select(F.inline("results"))
