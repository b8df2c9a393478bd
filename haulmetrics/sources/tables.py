"""Stored tables: Parquet, CSV and JSON sinks, catalog tables, SQL scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.functions.dates import parse_timestamp
from haulmetrics.functions.numeric import to_number
from haulmetrics.session import configure


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_first(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The first Parquet source that exists; an error if none does."""
    for path in paths:
        if path_exists(spark, path):
            return spark.read.parquet(path)
    raise FileNotFoundError(", ".join(paths))


INTEGER = r"^\s*[+-]?[0-9]+\s*$"
TEXT_TYPES = ("integer", "number", "timestamp")
FIRST_ROWS = 1_000


def describe_columns(df: DataFrame) -> DataFrame:
    """Name, position, known values and type of each column.

    A text column has the narrowest of integer, number, timestamp and text
    that all its known values fit, found in one aggregation of all rows; others
    keep the type that they have. A type that some value of the first rows does
    not fit is out already, so it is not tried on the rest.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]

    def fits(name: str) -> dict[str, Column]:
        c = F.col(name)
        return {"integer": c.rlike(INTEGER), "number": to_number(c).isNotNull(),
                "timestamp": parse_timestamp(c).isNotNull()}

    def counted(rows: DataFrame, tried: dict[str, list[str]]) -> list[list[int]]:
        measures = [F.array(F.count(c), *[F.count(F.when(fits(c)[label], 1)) for label in tried[c]])
                    for c in df.columns]
        return rows.agg(F.array(*measures)).first()[0]  # a few numbers a column

    def fitting(found: list[int], labels: list[str]) -> list[str]:
        return [label for label, n in zip(labels, found[1:]) if n == found[0]]

    tried = {c: list(TEXT_TYPES) if c in texts else [] for c in df.columns}
    first = counted(df.limit(FIRST_ROWS), tried)
    tried = {c: fitting(found, tried[c]) for c, found in zip(df.columns, first)}
    rows = []
    for i, ((name, kind), found) in enumerate(zip(df.dtypes, counted(df, tried)), start=1):
        if name in texts:
            kind = next(iter(fitting(found, tried[name])), "text") if found[0] else "text"
        rows.append((i, name, kind, found[0]))
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, known bigint")


def to_microseconds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nanosecond counts (read with ``spark.sql.legacy.parquet.nanosAsLong``) to timestamps."""
    return df.withColumns({c: F.timestamp_micros(F.floor(F.col(c) / 1000)) for c in columns})


def write_parquet(df: DataFrame, path: str, **options) -> None:
    """Overwrite a Parquet table; timestamps are stored in microseconds."""
    configure(df.sparkSession)
    df.write.mode("overwrite").options(**options).parquet(path)


#: Rows of a compressed text file, which is read by one task.
PACKED_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header; blanks at the ends of values are kept.

    ``compression`` such as "gzip" takes a fraction of the disk; no reader splits such
    files, so they are written in pieces.
    """
    writer = (df.write.mode("overwrite").option("header", True).option("escape", "\"")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression != "none":
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PACKED_ROWS)
    writer.csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one per file or one per line."""
    return spark.read.option("multiLine", False).json(path)


def store_raw(tables: dict[str, DataFrame], folder: str | None = None) -> list[str]:
    """Replace the raw tables in the catalog; returns their names.

    With ``folder`` the files go there (a shared path), else to the warehouse.
    """
    for name, df in tables.items():
        configure(df.sparkSession)
        writer = df.write.mode("overwrite").format("parquet")
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.saveAsTable(name)
    return list(tables)


def scan_sql(df: DataFrame, name: str) -> DataFrame:
    """Whole-table scan through SQL on a temporary view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def cached(df: DataFrame) -> tuple[DataFrame, int]:
    """Keep a frame for several uses and count it. The caller unpersists it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Gate: stop when a stage produced nothing."""
    if df.isEmpty():
        raise ValueError(f"{what}: 0 rows")
    return df
