"""Sequential row numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.functions.numeric import plain_zeros
from haulmetrics.session import stage

BLOCK = 100_000


def _marked(df: DataFrame, by: Sequence[str] | None,
            keep: Sequence[Column] | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Add the md5 of the ``by`` columns, its bucket, and what orders rows equal in them."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by or df.columns]
    rows = df.select(*(["*"] if keep is None else keep),
                     F.unhex(F.md5(F.concat_ws("|", *text))).alias("__digest"),
                     F.struct(*[(F.col(c) + F.lit(0.0)).cast(kind) if kind in ("double", "float")
                                else F.col(c) for c, kind in df.dtypes if c in ties],
                              F.xxhash64(*df.columns)).alias("__tie"))
    return rows.withColumn("__bucket", F.substring("__digest", 1, 2))


def _offsets(marked: DataFrame) -> DataFrame:
    """Rows of each bucket and in the buckets before it; at most 65,536 rows."""
    sizes = marked.groupBy("__bucket").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("__offset", F.coalesce(F.sum("__size").over(before), F.lit(0)))


def number_rows(df: DataFrame, by: Sequence[str] | None = None, *, start: int = 1,
                name: str = "row_number", block: int = BLOCK,
                keep: Sequence[Column] | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Add 1, 2, 3 ... in order of the md5 of the ``by`` columns (default: all).

    Spark rows have no file order, so the order is by content and the same for
    any partitioning. ``by`` should tell rows apart, save for exact copies; rows
    equal in it follow the columns ``ties``, in the order of ``df``, and a hash
    of the whole row. ``keep`` are the named columns
    that the numbered rows carry (default: those of ``df``); only what a query
    uses of them is shuffled, beside the md5 and the hash.
    The first four hex digits of the md5 cut the rows into 65,536 even
    buckets; bucket offsets come from their counts (a bounded table), and
    ranks are taken inside a bucket; this is the one shuffle of whole rows. In
    buckets of more than ``block`` rows exact copies are folded into one counted
    row first and unfolded in blocks, so many copies do not meet in one task.
    ``df`` is read twice and should come from a stored table.
    """
    marked = _marked(df, by, keep, ties)
    columns = [c for c in marked.columns if c not in ("__digest", "__tie", "__bucket")]
    return _numbered(marked, _offsets(marked), columns, start, name, block)


def number_file_rows(df: DataFrame, *, start: int = 1, name: str = "row_number") -> DataFrame:
    """Add 1, 2, 3 ... in the order of the rows in their files, files by path.

    ``df`` must be a scan of Parquet files (a source or staged table). Each file's rows
    are counted, a prefix sum over the files gives the rows before it, and a row adds its
    place in its file: no row is shuffled or hashed.
    """
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("__file"),
                           F.col("_metadata.row_index").alias("__place"))
    except AnalysisException as err:
        raise ValueError("only the rows of a Parquet table have a file order") from err
    sizes = placed.groupBy("__file").agg((F.max("__place") + 1).alias("__size"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each file; AQE broadcasts it by its size
    offsets = stage(sizes, "file_sizes").select(
        "__file", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    return placed.join(stage(offsets, "file_offsets"), "__file").select(
        *df.columns, (F.col("__offset") + F.col("__place") + start).cast("bigint").alias(name))


def _numbered(marked: DataFrame, offsets: DataFrame, columns: list[str], start: int, name: str,
              block: int) -> DataFrame:
    """Number the rows of the buckets in ``offsets``."""
    offsets = stage(offsets, "offsets")
    full = offsets.where(F.col("__size") > block)
    if full.isEmpty():
        return _ranked(marked, offsets, columns, start, name)
    large = F.broadcast(full.select("__bucket"))
    return _ranked(marked.join(large, "__bucket", "left_anti"), offsets, columns, start,
                   name).unionByName(_unfolded(marked.join(large, "__bucket", "left_semi"), full,
                                               columns, start, name, block))


def _ranked(marked: DataFrame, offsets: DataFrame, columns: list[str], start: int,
            name: str) -> DataFrame:
    """Number the rows of buckets that fit a task, row by row."""
    inside = Window.partitionBy("__bucket").orderBy("__digest", "__tie")
    ranked = plain_zeros(marked).withColumn("__rank", F.row_number().over(inside))
    number = F.col("__offset") + F.col("__rank") + F.lit(start - 1)
    return (ranked.join(F.broadcast(offsets.drop("__size")), "__bucket")
            .select(*columns, number.cast("bigint").alias(name)))


def _unfolded(marked: DataFrame, offsets: DataFrame, columns: list[str], start: int, name: str,
              block: int) -> DataFrame:
    """Number the rows of buckets of any size, copies folded."""
    folded = (marked.groupBy(*columns, "__digest", "__tie", "__bucket")
              .agg(F.count("*").alias("__copies")))
    inside = (Window.partitionBy("__bucket").orderBy("__digest", "__tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (folded.join(F.broadcast(offsets.drop("__size")), "__bucket")
              .withColumn("__first", F.col("__offset")
                          + F.coalesce(F.sum("__copies").over(inside), F.lit(0)) + F.lit(start)))

    few = placed.where(F.col("__copies") <= block)
    few = few.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__copies") - 1))
                     .alias("__i"))
    many = placed.where(F.col("__copies") > block)
    last_block = F.floor((F.col("__copies") - 1) / block)
    many = (many.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block))
                        .alias("__b"))
            .repartition("__digest", "__b"))
    span = F.least(F.lit(block), F.col("__copies") - F.col("__b") * block) - 1
    many = many.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), span)).alias("__j"))
    many = many.withColumn("__i", F.col("__b") * block + F.col("__j")).drop("__b", "__j")
    return few.unionByName(many).select(
        *columns, (F.col("__first") + F.col("__i")).cast("bigint").alias(name))


def page_slice(df: DataFrame, page: int, page_size: int = 500,
               by: Sequence[str] | None = None) -> DataFrame:
    """Rows of one 1-based page under the content order of ``number_rows``."""
    first = (page - 1) * page_size + 1
    last = first + page_size - 1
    marked = _marked(df, by)
    # the counts of the buckets tell which ones hold the page; no other row is shuffled
    offsets = _offsets(marked).where((F.col("__offset") < last)
                                     & (F.col("__offset") + F.col("__size") >= first))
    near = marked.join(F.broadcast(offsets.select("__bucket")), "__bucket", "left_semi")
    return (_numbered(near, offsets, df.columns, 1, "row_number", BLOCK)
            .where(F.col("row_number").between(first, last)))
