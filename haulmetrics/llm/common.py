"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.session import configure

#: Rows of one Arrow batch. Texts of a few KB make batches of a few MB.
BATCH_ROWS = 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators of this package assume."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, schema: str,
                fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def map_joined(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
               least_bytes: int) -> DataFrame:
    """Like ``map_batches``, for batches joined until they hold ``least_bytes``."""
    def join(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(some).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        for batch in batches:
            if batch.num_rows:
                some.append(batch)
                size += batch.nbytes
            if size >= least_bytes:
                yield fn(join(some))
                some, size = [], 0
        if some:
            yield fn(join(some))
    return df.mapInArrow(run, schema)


def crc32_mod(key: str, n: int) -> Column:
    """crc32 of a column as text, modulo ``n``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % n


def row_id(key: str = "doc_id", text: str = "text") -> Column:
    """What tells rows apart that may share a key or lack one: key (null last) and text."""
    return F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"),
                    F.xxhash64(F.col(text).isNull(), F.col(text)).alias("text"))


def join_by_row(docs: DataFrame, found: DataFrame, how: str, *, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Equi-join rows with ``found``, whose ``__id`` is a ``row_id``; a null key equals one.

    Keeps the columns of ``docs`` and those of ``found`` other than ``__id``.
    """
    names = ["__no_key", "__at_key", "__at_text"]

    def parts(row: Column) -> dict[str, Column]:
        # a key stands in for null, as a flag beside it tells them apart
        text_key = F.coalesce(row["key"].cast("string"), F.lit(""))
        return dict(zip(names, [row["no_key"], text_key, row["text"]]))

    left = docs.withColumns(parts(row_id(key, text)))
    right = found.withColumns(parts(F.col("__id"))).drop("__id")
    return left.join(right, names, how).drop(*names)
