"""Largest groups plus one row for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_with_rest(counts: DataFrame, label: str, amount: str, k: int = 7,
                  rest: str = "Other") -> DataFrame:
    """The ``k`` largest rows of a grouped table and, if any are left, their sum.

    Ties are broken by label. ``is_rest`` tells the summed row from a group
    that happens to carry the same name.
    """
    top = counts.orderBy(F.col(amount).desc(), F.col(label)).limit(k)
    marked = counts.join(
        F.broadcast(top.select(F.col(label).alias("__label"), F.lit(True).alias("__top"))),
        F.col(label).eqNullSafe(F.col("__label")), "left")
    is_rest = F.col("__top").isNull()
    return (marked.groupBy(F.when(is_rest, rest).otherwise(F.col(label)).alias(label),
                           is_rest.alias("is_rest"))
            .agg(F.sum(amount).alias(amount)))
