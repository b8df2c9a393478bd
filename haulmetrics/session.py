"""Session settings and the shared folder intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle files go when their query ends, not when the driver happens to collect garbage:
    # a run of several steps then holds the files of one step beside the staged tables
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every stage assumes."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master; on a cluster an
    unset folder is an error, since a machine-local path would lose data.
    """
    app = spark.conf.get("spark.app.id", "app")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="haulmetrics-")
        base = _local_dirs[app]
    return f"{base.rstrip('/')}/haulmetrics-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage: later passes read only the columns they need, and a lost
    executor costs a re-read rather than a re-computation.
    """
    spark = configure(df.sparkSession)
    path = new_path(spark, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application, once results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal out rows when a scan yields fewer partitions than there are cores.

    A no-op on any table of real size; it keeps one small file from pinning
    the work to one core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
