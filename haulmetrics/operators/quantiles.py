"""Exact quantiles per group without holding a large group in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.operators.attach import attach
from haulmetrics.session import stage

SMALL_GROUP = 1_000_000
ACCURACY = 10_000
GRID = 200


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], *,
                    largest: int | None = None, small_group: int = SMALL_GROUP,
                    accuracy: int = ACCURACY) -> DataFrame:
    """``keys``, ``n`` and array ``q`` of interpolated quantiles (position p * (n - 1)).

    ``df`` is read several times and should be a staged or source table; the
    result is a staged table. ``largest`` is the number of different values in
    the largest group, if already known; an estimate will do. Up to
    ``small_group`` of them, a group's values are counted and the counts
    cumulated in value order. In larger ones each wanted rank
    has a bracket of values that is narrowed in rounds: a mergeable sketch
    proposes narrower edges, exact counts on both sides of them tell where the
    rank is, and a proposal that misses it moves to the side that holds it.
    Only when at most ``small_group`` values are left between the edges are
    they counted one by one, so no task ever sees more, and the result is exact.
    """
    keys, probs = list(keys), list(probs)
    base = df.select(*keys, F.col(value).cast("double").alias("__v")).where("__v is not null")
    if largest is None:
        counts = base.groupBy(*keys).agg(different("__v").alias("n"))
        largest = counts.agg(F.max("n")).first()[0] or 0
    if largest <= small_group:
        return stage(_ranked(base, keys, probs), "quantiles")
    if keys:
        return _bracketed(base, keys, probs, small_group, accuracy)
    return _bracketed(base.withColumn("__all", F.lit(1)), ["__all"], probs, small_group,
                      accuracy).drop("__all")


def different(value: str) -> Column:
    """Estimated number of different values; never more than there are values."""
    return F.least(F.approx_count_distinct(value), F.count(value))


def _positions(probs: Sequence[float]) -> list[Column]:
    return [F.lit(float(p)) * (F.col("n") - 1) for p in probs]


def _mixed(probs: Sequence[float], low: list[Column], high: list[Column]) -> Column:
    """Values at the ranks below and above each position, interpolated."""
    return F.array(*[a + (b - a) * (x - F.floor(x))
                     for a, b, x in zip(low, high, _positions(probs))])


def _ranked(rows: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of groups with few different values, from counts cumulated in value order."""
    counts = rows.groupBy(*keys, "__v").agg(F.count("*").alias("c"))
    group = Window.partitionBy(*keys)
    order = group.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select(*keys, "__v", "c", F.sum("c").over(order).alias("upto"),
                           F.sum("c").over(group).alias("n"))

    def value_at(rank: Column) -> Column:
        hit = (F.col("upto") - F.col("c") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(hit, F.col("__v")))

    picks = []
    for i, x in enumerate(_positions(probs)):
        picks += [value_at(F.floor(x)).alias(f"a{i}"), value_at(F.ceil(x)).alias(f"b{i}")]
    ranked = counts.groupBy(*keys, "n").agg(*picks)
    low, high = ([F.col(f"{side}{i}") for i in range(len(probs))] for side in "ab")
    return ranked.select(*keys, "n", _mixed(probs, low, high).alias("q"))


def _bracketed(base: DataFrame, keys: list[str], probs: list[float], small_group: int,
               accuracy: int) -> DataFrame:
    """Quantiles of groups of any size. A rank's bracket is the struct (rank, lo, hi)."""
    slack = 2.0 / accuracy
    edges = [e for p in probs for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = F.percentile_approx("__v", F.array(*[F.lit(e) for e in edges]), accuracy)
    state = base.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__v").alias("min"),
                                    F.max("__v").alias("max"), sketch.alias("edges"))
    brackets = []
    for i, x in enumerate(_positions(probs)):
        for rank in (F.floor(x), F.ceil(x)):
            brackets.append(F.struct(rank.cast("bigint").alias("rank"),
                                     F.col("edges")[2 * i].alias("lo"),
                                     F.col("edges")[2 * i + 1].alias("hi")))
    state = stage(state.select(*keys, "n", "min", "max", F.array(*brackets).alias("b")), "brackets")
    targets = 2 * len(probs)
    limit = max(1, small_group // targets)
    while True:
        state = stage(_measured(base, state, keys, targets), "brackets")
        wide = F.exists("b", lambda x: (x["lo"] < x["hi"]) & ((x["light"] > limit) | x["missed"]))
        if state.where(wide).isEmpty():
            break
        state = stage(_narrowed(base, state, keys, targets, limit, accuracy), "brackets")
    return stage(_counted(base, state, keys, probs), "quantiles")


def _measured(base: DataFrame, state: DataFrame, keys: list[str], targets: int) -> DataFrame:
    """Exact counts below, at and between the edges; each bracket fitted to its rank."""
    rows = attach(base, state.select(*keys, "b", "n"), keys, weight="n", null_safe=True)
    v = F.col("__v")
    counts = []
    for t in range(targets):
        lo, hi = F.col("b")[t]["lo"], F.col("b")[t]["hi"]
        for name, test in (("below", v < lo), ("at", v == lo), ("light", (lo < v) & (v < hi)),
                           ("top", (v == hi) & (lo < hi))):
            counts.append(F.count(F.when(test, 1)).alias(f"{name}{t}"))
    sums = rows.groupBy(*keys).agg(*counts, F.count("*").alias("__w"))
    found = attach(state, stage(sums, "counts"), keys, weight="__w", null_safe=True)
    fitted = []
    for t in range(targets):
        b = F.col("b")[t]
        below, at, light, top = (F.col(f"{x}{t}") for x in ("below", "at", "light", "top"))
        rank, lo, hi = b["rank"], b["lo"], b["hi"]
        under, over = rank < below, rank >= below + at + light + top
        on_lo = ~under & (rank < below + at)
        on_hi = ~under & ~over & (rank >= below + at + light)
        fitted.append(F.struct(
            rank.alias("rank"),
            F.when(under, F.col("min")).when(over | on_hi, hi).otherwise(lo).alias("lo"),
            F.when(under | on_lo, lo).when(over, F.col("max")).otherwise(hi).alias("hi"),
            (below + at).alias("before"), light.alias("light"),
            (under | over).alias("missed")))
    return found.select(*keys, "n", "min", "max", F.array(*fitted).alias("b"))


def _narrowed(base: DataFrame, state: DataFrame, keys: list[str], targets: int, limit: int,
              accuracy: int) -> DataFrame:
    """Closer edges for brackets with more than ``limit`` values between them."""
    rows = attach(base, state.select(*keys, "b", "n"), keys, weight="n", null_safe=True)
    rows = rows.select(*keys, "__v", F.posexplode("b").alias("__t", "__x")).where(
        (F.col("__x.light") > limit) & ~F.col("__x.missed")
        & (F.col("__x.lo") < F.col("__v")) & (F.col("__v") < F.col("__x.hi")))
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    grids = (rows.groupBy(*keys, "__t").agg(F.percentile_approx("__v", steps, accuracy).alias("__g"))
             .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__t", "__g")))
                                 .alias("grids"), F.count("*").alias("__w")))
    found = attach(state, stage(grids, "grids"), keys, weight="__w", null_safe=True)
    spare = 1 + math.ceil(2 * GRID / accuracy)  # the sketch's own error, in steps
    closer = []
    for t in range(targets):
        b, grid = F.col("b")[t], F.col("grids")[t]
        at = F.floor(GRID * (b["rank"] - b["before"]) / F.greatest(b["light"], F.lit(1)))
        low = F.get(grid, F.greatest(at - spare, F.lit(0)).cast("int"))
        high = F.get(grid, F.least(at + spare + 1, F.lit(GRID)).cast("int"))
        closer.append(F.struct(b["rank"].alias("rank"), F.coalesce(low, b["lo"]).alias("lo"),
                               F.coalesce(high, b["hi"]).alias("hi")))
    return found.select(*keys, "n", "min", "max", F.array(*closer).alias("b"))


def _counted(base: DataFrame, state: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """The value at each rank; what lies between the edges is counted one by one."""
    rows = attach(base, state.select(*keys, "b", "n"), keys, weight="n", null_safe=True)
    rows = rows.select(*keys, "__v", F.posexplode("b").alias("__t", "__x")).where(
        (F.col("__x.lo") < F.col("__v")) & (F.col("__v") < F.col("__x.hi")))
    counts = rows.groupBy(*keys, "__t", F.col("__x.rank").alias("rank"),
                          F.col("__x.before").alias("before"), "__v").agg(F.count("*").alias("c"))
    order = (Window.partitionBy(*keys, "__t").orderBy("__v")
             .rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("before") + F.sum("c").over(order)
    hits = (counts.withColumn("upto", upto)
            .where((F.col("upto") - F.col("c") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
            .groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__t", "__v")))
                                .alias("found"), F.count("*").alias("__w")))
    out = attach(state, stage(hits, "ranks"), keys, weight="__w", null_safe=True)

    def value_at(t: int) -> Column:
        b = F.col("b")[t]
        return F.when(b["lo"] == b["hi"], b["lo"]).otherwise(F.col("found")[t])

    low, high = ([value_at(2 * i + side) for i in range(len(probs))] for side in (0, 1))
    return out.select(*keys, "n", _mixed(probs, low, high).alias("q"))


def exact_median(df: DataFrame, value: str, **options) -> float | None:
    """Median of one whole column, as a driver-side number."""
    row = exact_quantiles(df, [], value, [0.5], **options).first()
    return row["q"][0] if row else None


def counted_median(counts: DataFrame, value: str, count: str, *,
                   small: int = SMALL_GROUP) -> float | None:
    """Median of a column of which the distinct values and their counts are given.

    ``counts`` is read several times and should be a staged table. The range that holds
    the middle is narrowed, by a grid of the distinct values and exact sums up to its
    lines, until ``small`` of them are left; null values and counts of 0 do not count.
    """
    rows = counts.select(F.col(value).cast("double").alias("v"), F.col(count).alias("c")).where(
        "v is not null and c > 0")
    total, left = rows.agg(F.sum("c"), F.count("*")).first()
    if not total:
        return None
    first, last = (total - 1) // 2, total // 2
    below = 0
    while left > small:
        steps = F.array(*[F.lit(i / GRID) for i in range(1, GRID)])
        lines = sorted(set(rows.agg(F.percentile_approx("v", steps, ACCURACY)).first()[0]))
        upto = rows.agg(*[F.sum(F.when(F.col("v") <= line, F.col("c")).otherwise(0))
                          for line in lines]).first()
        under = [(n, line) for n, line in zip(upto, lines) if below + n <= first]
        over = [line for n, line in zip(upto, lines) if below + n > last]
        if under:
            rows = rows.where(F.col("v") > under[-1][1])
            below += under[-1][0]
        if over:
            rows = rows.where(F.col("v") <= over[0])
        before, left = left, rows.count()
        if left == before:
            break
    # at most ``small`` rows, in one task
    order = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.select("v", F.sum("c").over(order).alias("upto")).agg(
        F.min(F.when(F.col("upto") > first - below, F.col("v"))),
        F.min(F.when(F.col("upto") > last - below, F.col("v")))).first()
    return ends[0] + (ends[1] - ends[0]) / 2
