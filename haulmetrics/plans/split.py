"""Modelling table and its reproducible split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.functions.hashing import stable_fraction
from haulmetrics.functions.numeric import round_even, share
from haulmetrics.sources.tables import write_csv
from haulmetrics.schema import SPLIT_FEATURES, SPLIT_IDS, SPLIT_TARGETS

TEST_SHARE = 0.20


def modelling_table(df: DataFrame) -> DataFrame:
    return df.select(*SPLIT_IDS, *SPLIT_FEATURES, *SPLIT_TARGETS)


def with_split(df: DataFrame, test_share: float = TEST_SHARE) -> DataFrame:
    """Column ``split``: 'test' or 'train' by the hash of the order id alone."""
    is_test = stable_fraction("order_id") < F.lit(test_share)
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def train_test(df: DataFrame, test_share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, test_share)
    return (marked.where("split = 'train'").drop("split"),
            marked.where("split = 'test'").drop("split"))


def overlap(train: DataFrame, test: DataFrame) -> DataFrame:
    """Order ids present on both sides; none are expected."""
    return train.select("order_id").intersect(test.select("order_id"))


def test_share_of(marked: DataFrame) -> DataFrame:
    return marked.agg(round_even(share(F.col("split") == "test"), 4).alias("test_share"))


def class_balance(df: DataFrame, name: str = "share") -> DataFrame:
    """Share of each known ``is_delayed`` value."""
    counts = df.where("is_delayed is not null").groupBy("is_delayed").agg(
        F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("is_delayed", round_even(F.col("n") / total, 4).alias(name))


def class_balance_by_split(marked: DataFrame) -> DataFrame:
    """Train and test balance side by side; a class missing on one side is null."""
    train = class_balance(marked.where("split = 'train'"), "train")
    test = class_balance(marked.where("split = 'test'"), "test")
    return train.join(test, "is_delayed", "full")


def write_split(df: DataFrame, folder: str) -> DataFrame:
    """Write the modelling table partitioned by split, and one flat CSV copy."""
    marked = with_split(modelling_table(df))
    marked.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/split")
    stored = df.sparkSession.read.parquet(f"{folder}/split")
    write_csv(stored.drop("split"), f"{folder}/flat_csv")
    return stored
