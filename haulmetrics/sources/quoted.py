"""CSV records that go on over line breaks inside quotes, read in splits.

Whether a line starts inside a quoted value depends on all quotes before it in its file.
Each block of a file counts its lines with an odd number of quotes, and a prefix sum over
the blocks tells each block the state it starts in. Such lines open and close torn records
by turns, so only they are numbered, inside their blocks; the lines between an opening and
its closing line are found by their ids and joined. All other lines are records as they
are. No file is one task, and only lines of torn records are shuffled by record.

A quote inside a value is doubled, as CSV writers do. A file whose quotes do not balance is
an error. Lines end with a line feed, or a carriage return and a line feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmetrics.session import stage


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, block, an id in file order inside the block, and whether the
    number of quotes is odd."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"))
            .withColumn("id", F.monotonically_increasing_id())
            .withColumn("odd", quotes % 2 == 1))


def _blocks(read: DataFrame) -> DataFrame:
    """Blocks with their first and last id and the odd lines of the file before them."""
    found = stage(read.groupBy("file", "block").agg(
        F.min("id").alias("first"), F.max("id").alias("last"),
        F.count_if("odd").alias("n_odd")), "csv_blocks")
    before = (Window.partitionBy("file").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("before", F.coalesce(F.sum("n_odd").over(before), F.lit(0)))


def _torn_lines(read: DataFrame, blocks: DataFrame) -> DataFrame:
    """File, record and id of every line of a torn record."""
    place = Window.partitionBy("file", "block").orderBy("id")
    odd = (read.where("odd").select("file", "block", "id")
           .withColumn("rank", F.row_number().over(place))
           .join(blocks.select("file", "block", "before"), ["file", "block"])
           .withColumn("record", F.floor((F.col("before") + F.col("rank") - 1) / 2)))
    at = F.struct("block", "id")
    spans = stage(odd.groupBy("file", "record").agg(F.min(at).alias("open"),
                                                    F.max(at).alias("close")), "csv_spans")
    inside = spans.where("open.block = close.block").select(
        "file", "record", F.col("open.id").alias("low"), F.col("close.id").alias("high"))
    # a block's edge is crossed by one record at most
    across = spans.where("open.block < close.block").join(
        blocks.select("file", "block", "first", "last"), "file").where(
        "block BETWEEN open.block AND close.block").select(
        "file", "record",
        F.expr("if(block = open.block, open.id, first)").alias("low"),
        F.expr("if(block = close.block, close.id, last)").alias("high"))
    return stage(inside.unionByName(across).select(
        "file", "record", F.explode(F.sequence("low", "high")).alias("id")), "csv_torn_lines")


def read_records(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records of CSV files with the header ``columns``, as text columns."""
    read = lines(spark, path)
    blocks = _blocks(read)
    uneven = blocks.groupBy("file").agg(F.sum("n_odd").alias("n")).where("n % 2 = 1").head(1)
    if uneven:
        raise ValueError(f"{uneven[0]['file']}: quotes do not balance")
    torn = _torn_lines(read, blocks)
    heads = blocks.where("block = 0").select(F.col("first").alias("id"))
    names = read.join(heads, "id").select(F.regexp_replace("value", "\r$", "").alias("value"),
                                          "odd").distinct().head(2)
    if len(names) > 1 or any(r["odd"] for r in names):
        raise ValueError(f"{path}: files of different headers, or a header of several lines")

    rows = F.sort_array(F.collect_list(F.struct("block", "id", "value")))
    joined = (read.join(torn, ["file", "id"]).groupBy("file", "record")
              .agg(F.array_join(rows["value"], "\n").alias("value")).select("value"))
    whole = read.join(torn.select("id").unionByName(heads), "id", "left_anti").select("value")
    record = F.regexp_replace("value", "\r$", "")
    schema = ", ".join(f"c{i} string" for i in range(len(columns)))
    parsed = F.from_csv("record", schema, {"escape": '"', "mode": "PERMISSIVE"})
    return (whole.unionByName(joined).select(record.alias("record")).where("record <> ''")
            .select(parsed.alias("row"))
            .select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(columns)]))
