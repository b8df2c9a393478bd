"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of each source are cut into blocks of ``block_words`` words. The blocks of the
mix are apportioned to the sources by highest quotients ``target / (2 s + 1)``, s being
the blocks a source has already. A source's blocks are apportioned to its shards by the
same rule with the shards' words as weights. Inside a shard the documents stand in an
order drawn from the seed, and the shard's quota is filled from the first block on: every
block once for each full pass over the shard, and the first ones of the drawn order once
more. So only the documents at a shard's cut are taken in part.

Shards hold about ``shard_words`` words and ``SHARD_ROWS`` rows, so a source with a third
of all rows is many shards, whether its rows have words and keys or not. Only keys and
sizes are shuffled, never texts. Equal rows travel as one row with a count, in blocks of
``COPIES``, and are unfolded at the end. Up to ``MAX_SOURCES`` sources the driver plans
them; more are numbered, capped and apportioned in groups of ``GROUP_SOURCES`` by tasks.
Shards are apportioned in groups of ``GROUP_SHARDS``, so no task sees all of a source.

Null texts have no words. A null source is one source. Documents without words take part
with size 0. Rows that repeat a key are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.llm.common import map_batches
from haulmetrics.operators.attach import attach
from haulmetrics.session import stage

MAX_SOURCES = 100_000
GROUP_SOURCES = 100_000
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 19
SHARD_ROWS = 1 << 17
COPIES = 4096
GROUP_SHARDS = 1024


def sainte_lague(weights: Sequence[float], seats: int,
                 limits: Sequence[int] | None = None) -> list[int]:
    """Seats by highest quotients ``weight / (2 s + 1)``, at most ``limits`` each.

    Ties go to the first. Starts from the rounded shares, which are the solution for
    some number of seats, and hands out or takes back the difference one by one.
    """
    n = len(weights)
    limits = [math.inf] * n if limits is None else list(limits)
    total = sum(weights)
    if not total or seats <= 0:
        return [0] * n
    got = [int(min(limit, math.floor(w * seats / total + 0.5)))
           for w, limit in zip(weights, limits)]
    spare = seats - sum(got)
    if spare > 0:
        heap = [(-w / (2 * s + 1), i) for i, (w, s) in enumerate(zip(weights, got))
                if s < limits[i] and w]
        heapq.heapify(heap)
        while spare and heap:
            _, i = heapq.heappop(heap)
            got[i] += 1
            spare -= 1
            if got[i] < limits[i]:
                heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    elif spare < 0:
        heap = [(w / (2 * s - 1), -i) for i, (w, s) in enumerate(zip(weights, got)) if s]
        heapq.heapify(heap)
        while spare:
            _, i = heapq.heappop(heap)
            got[-i] -= 1
            spare += 1
            if got[-i]:
                heapq.heappush(heap, (weights[-i] / (2 * got[-i] - 1), i))
    return got


def capped_targets(sizes: Sequence[int], weights: Sequence[float], share: float,
                   most: float) -> list[float]:
    """Shares of ``share`` times all sizes by weight, none above ``most`` times its size;
    what is above goes to the others by weight until none is."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        for i in over or open_:
            targets[i] = most * sizes[i] if over else weights[i] * unit
        if not over:
            break
        left -= sum(targets[i] for i in over)
        open_ -= set(over)
    return targets


def word_count(text: Column | str) -> Column:
    """Number of runs without blanks and control white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text,
                                     F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cycled(weights: Sequence[float]):
    """Weights dealt to the sources in order of their name, repeating."""
    return lambda names, first=0: [weights[(first + i) % len(weights)]
                                   for i in range(len(names))]


def mix(docs: DataFrame, weigh, *, key: str = "doc_id", source: str = "source",
        text: str = "text", share: float = 1.5, most: float = 2.0, seed: int = 42,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: key, size, source, source_size, target, taken, passes.

    ``weigh`` maps the source names, in order of code points with null last, to weights;
    beyond ``MAX_SOURCES`` sources it is called for each alone, with its place as ``first``.
    ``share`` is the mix's size as a multiple of all words, ``most`` the limit of a
    source's target as a multiple of its words. ``passes`` is how often the document
    is taken, a part of half or more counting as the whole.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"),
                             F.xxhash64(F.col(text).isNull(), F.col(text))))
    rows = docs.select(F.col(key).alias("__key"), F.col(source).alias("__source"),
                       word_count(text).alias("__size"), draw.alias("__draw"))
    sized = stage(_in_blocks(rows), "sizes")
    totals = sized.groupBy("__source").agg(F.sum(F.col("__size") * F.col("__n")).alias("__words"),
                                           F.sum("__n").alias("__rows"))
    few = totals.limit(MAX_SOURCES + 1).collect()
    plan = (_plan_by_tasks(stage(totals, "sources"), weigh, share, most, block_words)
            if len(few) > MAX_SOURCES
            else _plan(docs.sparkSession, few, weigh, share, most, block_words))

    # a shard's last block is short, so that a source has up to one more block a shard
    shards = 1 + F.greatest(F.floor(F.col("__words") / shard_words),
                            F.floor(F.col("__rows") / SHARD_ROWS))
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit("shard"), "__draw")), 1, 12), 16, 10)
    named = attach(sized, plan.withColumns({"__shards": shards, "__weight": F.col("__rows")}),
                   ["__source"], weight="__weight", null_safe=True)
    dealt = stage(named.select("__key", "__source", "__size", "__draw", "__n", "__words",
                               "__target", "__sid",
                               (bucket.cast("bigint") % F.col("__shards")).alias("__shard")),
                  "dealt")
    quota = _shard_quotas(dealt, plan.select("__sid", "__quota"), block_words, most)

    in_shard = Window.partitionBy("__sid", "__shard").orderBy("__draw", "__key", "__size")
    whole = F.col("__size") * F.col("__n")
    placed = (dealt.withColumn("__start", F.sum(whole).over(
                  in_shard.rowsBetween(Window.unboundedPreceding, 0)) - whole)
              .join(quota, ["__sid", "__shard"])
              .withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                         F.col("__n") - 1))))
    full = F.floor(F.col("__got") / F.greatest("__blocks", F.lit(1))).cast("bigint")
    cut = (F.col("__got") - full * F.col("__blocks")) * block_words
    part = F.greatest(F.lit(0), F.least(
        "__size", cut - F.col("__start") - F.col("__copy") * F.col("__size")))
    placed = placed.withColumns({"__full": full, "__part": part.cast("bigint")})
    return placed.select(
        F.col("__key").alias(key), F.col("__source").alias("source"),
        F.col("__size").alias("size"), F.col("__words").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__full") * F.col("__size") + F.col("__part")).alias("taken"),
        (F.col("__full") + F.when((F.col("__part") * 2 >= F.col("__size"))
                                  & ((F.col("__size") > 0) | (F.col("__full") == 0)), 1)
         .otherwise(0)).cast("int").alias("passes"))


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Equal rows folded into blocks of ``COPIES`` at most (``__n``), each with its draw."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("__all"))
    last = F.floor((F.col("__all") - 1) / COPIES).cast("bigint")
    blocks = counted.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return blocks.select(
        "__key", "__source", "__size",
        F.when(F.col("__block") == 0, F.col("__draw"))
        .otherwise(F.md5(F.concat_ws(":", "__draw", F.col("__block").cast("string"))))
        .alias("__draw"),
        F.least(F.lit(COPIES), F.col("__all") - F.col("__block") * COPIES).alias("__n"))


PLAN = ("__source string, __words long, __rows long, __target double, __sid long, "
        "__quota long")


def _plan(spark, rows: list, weigh, share: float, most: float, block_words: int) -> DataFrame:
    """Number, target and quota of blocks of every source, by the driver."""
    rows = sorted(rows, key=lambda r: (r[0] is None, (r[0] or "").encode()))
    words = [r[1] for r in rows]
    targets = capped_targets(words, weigh([r[0] for r in rows]), share, most)
    limits = [int(most * (w // block_words + 1)) for w in words]
    quotas = sainte_lague(targets, round(sum(targets) / block_words), limits)
    return spark.createDataFrame(
        [(*r, t, i, q) for i, (r, t, q) in enumerate(zip(rows, targets, quotas))], PLAN)


def _plan_by_tasks(totals: DataFrame, weigh, share: float, most: float,
                   block_words: int) -> DataFrame:
    """The same for any number of sources; the driver reads one row a group of sources.

    Groups of neighbours get their blocks by the highest quotients of their joint targets,
    then sources get theirs inside the group.
    """
    # numbers in order of the names: ranges of names, then places inside each range
    ordered = stage(totals.repartitionByRange(F.col("__source").isNull(), F.col("__source"))
                    .withColumn("__range", F.spark_partition_id()), "source_ranges")
    first, offsets = 0, []
    for number, n in sorted(map(tuple, ordered.groupBy("__range").count().collect())):
        offsets.append((number, first))
        first += n
    starts = totals.sparkSession.createDataFrame(offsets, "__range int, __first long")
    at = Window.partitionBy("__range").orderBy(F.col("__source").isNull(), "__source")
    numbered = (ordered.join(F.broadcast(starts), "__range")
                .select("__source", "__words", "__rows",
                        (F.col("__first") + F.row_number().over(at) - 1).alias("__sid")))

    def weighed(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights = [weigh([name], first=i)[0] for name, i in
                   zip(batch["__source"].to_pylist(), batch["__sid"].to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights, pa.float64())],
                                          [*batch.schema.names, "__w"])

    sources = stage(map_batches(numbered, "__source string, __words long, __rows long, "
                                          "__sid long, __w double", weighed), "source_weights")
    limit = most * F.col("__words")

    def over(unit: float):
        return F.col("__w") * unit > limit

    # the share of a weight of one grows with every source found at its limit
    total, weights = sources.agg(F.sum("__words"), F.sum("__w")).first()
    unit, closed = share * total / weights, -1
    while True:
        n, taken, weights = sources.agg(
            F.count(F.when(over(unit), 1)),
            F.coalesce(F.sum(F.when(over(unit), limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over(unit), F.col("__w"))), F.lit(0.0))).first()
        if n == closed or not weights:
            break
        unit, closed = (share * total - taken) / weights, n
    target = F.when(over(unit), limit).otherwise(F.col("__w") * unit)
    sources = stage(sources.select(
        "__source", "__words", "__rows", F.col("__sid").alias("__number"),
        target.alias("__weight"), F.floor(F.col("__sid") / GROUP_SOURCES).alias("__sid"),
        (F.floor(F.col("__words") / block_words) + 1).alias("__blocks")), "source_targets")

    groups = sorted(map(tuple, sources.groupBy("__sid").agg(
        F.sum("__weight"), F.sum(F.floor(most * F.col("__blocks")))).collect()))
    seats = round(sum(g[1] for g in groups) / block_words)
    given = sainte_lague([g[1] for g in groups], seats, [g[2] for g in groups])
    quotas = totals.sparkSession.createDataFrame(
        [(g[0], q) for g, q in zip(groups, given)], "__sid long, __quota long")
    got = _apportion(sources.join(F.broadcast(quotas), "__sid"), ["__sid"], "__number", most)
    return stage(sources.drop("__sid", "__blocks")
                 .join(got.select(F.col("__child").alias("__number"), "__got"), "__number")
                 .select("__source", "__words", "__rows", F.col("__weight").alias("__target"),
                         F.col("__number").alias("__sid"), F.col("__got").alias("__quota")),
                 "source_plan")


def _shard_quotas(dealt: DataFrame, quotas: DataFrame, block_words: int,
                  most: float) -> DataFrame:
    """Blocks of each shard and how many of them it gives, apportioned in two steps."""
    shards = stage(dealt.groupBy("__sid", "__shard").agg(F.sum(F.col("__size") * F.col("__n")).alias("__weight"))
                   .withColumns({"__blocks": F.ceil(F.col("__weight") / block_words),
                                 "__group": F.floor(F.col("__shard") / GROUP_SHARDS)}), "shards")
    groups = (shards.groupBy("__sid", "__group")
              .agg(F.sum("__weight").alias("__weight"), F.sum("__blocks").alias("__blocks"))
              .join(quotas, "__sid"))
    groups = (_apportion(groups, ["__sid"], "__group", most)
              .select("__sid", F.col("__child").alias("__group"), F.col("__got").alias("__quota")))
    return (_apportion(shards.join(groups, ["__sid", "__group"]), ["__sid", "__group"], "__shard",
                       most)
            .select("__sid", F.col("__child").alias("__shard"), "__blocks", "__got"))


def _apportion(children: DataFrame, parent: list[str], child: str, most: float) -> DataFrame:
    """Seats (``__quota``) of each parent to its children by ``__weight``."""
    def give(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(child)
        got = sainte_lague(pdf["__weight"].tolist(), int(pdf["__quota"].iloc[0]),
                           [int(most * b) for b in pdf["__blocks"]])
        return pd.DataFrame({"__sid": pdf["__sid"], "__child": pdf[child],
                             "__blocks": pdf["__blocks"], "__got": got})

    return (children.select(*parent, child, "__weight", "__blocks", "__quota").groupBy(*parent)
            .applyInPandas(give, "__sid long, __child long, __blocks long, __got long"))
