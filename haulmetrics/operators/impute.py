"""Fill missing numbers from group medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.operators.attach import attach
from haulmetrics.operators.quantiles import different, exact_median, exact_quantiles


def _group_values(df: DataFrame, specs: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Narrow (spec, group, value) records for all (column, keys) pairs.

    One partially aggregated shuffle then serves every column. Groups with a
    missing key get no group.
    """
    records = [F.struct(F.lit(i).alias("spec"), _group_key(keys).alias("group"),
                        F.col(column).cast("double").alias("value"))
               for i, (column, keys) in enumerate(specs)]
    return df.select(F.explode(F.array(*records)).alias("r")).select("r.*")


def _group_key(keys: Sequence[str]) -> Column:
    """The key columns as one text; null when any of them is missing."""
    parts = [F.col(k).cast("string") for k in keys]
    return F.concat(*[x for part in parts for x in (part, F.lit("\u0001"))])


def fill_from_groups(df: DataFrame, specs: Sequence[tuple[str, Sequence[str]]],
                     **options) -> DataFrame:
    """Replace missing values of each column by its group median, else by the
    median of the column after that first fill. Observed values never change.

    ``df`` should be a staged table.
    """
    values = _group_values(df, specs)
    n, rows = F.col("n"), F.col("rows")
    sizes = values.groupBy("spec", "group").agg(F.count("*").alias("rows"),
                                                F.count("value").alias("n"),
                                                different("value").alias("different"))
    # One row per spec: missing values, those no group can fill, most values in a group.
    facts = {r["spec"]: r for r in sizes.groupBy("spec").agg(
        F.sum(rows - n).alias("missing"),
        F.sum(F.when((n == 0) | F.col("group").isNull(), rows - n)).alias("unfilled"),
        F.max(F.when(F.col("group").isNotNull(), F.col("different"))).alias("largest")).collect()}
    wanted = [i for i, fact in facts.items() if fact["missing"]]
    if not wanted:
        return df
    medians = exact_quantiles(
        values.where(F.col("group").isNotNull() & F.col("spec").isin(wanted)), ["spec", "group"],
        "value", [0.5], largest=max(facts[i]["largest"] or 0 for i in wanted), **options)

    columns, out = df.columns, df
    for i, (column, keys) in enumerate(specs):
        if i not in wanted:
            continue
        table = medians.where(F.col("spec") == i).select(
            F.col("group").alias("__group"), F.col("q")[0].alias("__median"), "n")
        # rows with a value need no median: without a group they stay where they are
        group = F.when(F.col(column).isNull(), _group_key(keys))
        out = attach(out.withColumn("__group", group), table, ["__group"], weight="n")
        out = out.withColumn(column, F.coalesce(column, "__median")).select(*columns)
        if facts[i]["unfilled"]:
            rest = exact_median(out, column, **options)
            out = out.withColumn(column, F.coalesce(column, F.lit(rest).cast("double")))
    return out
