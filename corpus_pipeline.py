"""Corpus pipeline: documents to token shards in five stages.

1. quality: documents that the line model scores below its threshold go.
2. near_dedup: of each group of SimHash near-duplicates, the row with the smallest key stays
   (null keys last); shingle length and distance are those of ``simhash``.
3. decontaminate: documents that hold a window of a benchmark item go.
4. mix: sources are taken to their target weights; a document stands in the result as
   often as the mix takes it, a part of half or more counting as the whole. Words are
   the unit, so a document without words stays once.
5. token_shards: the rows in order of their key as token ids, read back from the shards.

Rows are told apart by key and text, so repeated or null keys do no harm; a table may have
other columns, which stages 1 to 4 hand on. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmetrics.llm import line_quality, phrase_index, simhash, source_mix, token_shards
from haulmetrics.llm.common import join_by_row, prepare, row_id, table
from haulmetrics.session import stage

WEIGHTS = [3, 1, 2]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = line_quality.fit(docs, table(spark, sf_dir, "labels"))
    return line_quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = docs.select(row_id().alias("__id"), F.col("text").alias("__body"))
    groups = simhash.near_duplicates(rows, key="__id", text="__body")
    first = stage(groups.where("__id = component_id").groupBy("__id")
                  .agg(F.count("*").alias("__copies")), "first_of_group")
    kept = join_by_row(docs, first.select("__id"), "left_semi")
    if first.where("__copies > 1").isEmpty():
        return kept
    # rows that repeat key and text: one of them, folded before the shuffle
    repeated = first.where("__copies > 1").select("__id")
    single = join_by_row(docs, first.where("__copies = 1").select("__id"), "left_semi")
    several = docs.withColumn("__id", row_id()).dropDuplicates(["__id"]).drop("__id")
    return single.unionByName(join_by_row(several, repeated, "left_semi"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = docs.select(row_id().alias("__id"), F.col("text").alias("__body"))
    found = phrase_index.contamination(rows, table(spark, sf_dir, "benchmark"), key="__id",
                                       text="__body")
    hit = stage(found.where("n_hit > 0").select("__id").distinct(), "contaminated")
    return join_by_row(docs, hit, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = docs.select(row_id().alias("__id"), F.col("text").alias("__body"),
                       F.col("source").alias("__origin"))
    taken = source_mix.mix(rows, source_mix.cycled(WEIGHTS), key="__id", text="__body",
                           source="__origin")
    passes = stage(taken.groupBy("__id").agg(F.max("passes").alias("__passes"))
                   .where("__passes > 0"), "passes")
    return (join_by_row(docs, passes, "inner")
            .withColumn("__pass", F.explode(F.sequence(F.lit(1), F.col("__passes"))))
            .select(*docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_shards.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mix", mix), ("token_shards", tokens)]

#: SQL cannot express the trained classifier; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
