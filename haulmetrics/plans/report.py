"""Report and exploration figures over the featured orders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmetrics.functions.dates import month_text
from haulmetrics.functions.hashing import uniform
from haulmetrics.functions.numeric import round_even
from haulmetrics.functions.text import mentions
from haulmetrics.operators.quantiles import exact_median, exact_quantiles
from haulmetrics.operators.ranking import top_with_rest
from haulmetrics.plans.split import with_split
from haulmetrics.plans.totals import group_totals, mean
from haulmetrics.schema import DISTANCE_LABELS, SPLIT_FEATURES, SPLIT_TARGETS


def counts_by(df: DataFrame, label: str, name: str = "orders") -> DataFrame:
    """Rows per known label, largest first."""
    return (df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias(name))
            .orderBy(F.col(name).desc(), label))


# --- summary document ----------------------------------------------------

def delay_stats(df: DataFrame, **options) -> DataFrame:
    """Mean, median, sample deviation, minimum and maximum of the delay."""
    median = exact_median(df, "delivery_delay", **options)
    return df.agg(round_even(F.avg("delivery_delay"), 3).alias("mean"),
                  F.lit(median).cast("double").alias("median"),
                  round_even(F.stddev_samp("delivery_delay"), 3).alias("std"),
                  F.min("delivery_delay").cast("double").alias("min"),
                  F.max("delivery_delay").cast("double").alias("max"))


def on_time_by_carrier(df: DataFrame) -> DataFrame:
    return (df.where("carrier is not null").groupBy("carrier")
            .agg(round_even(1 - F.avg("is_delayed"), 4).alias("on_time_rate")))


def delay_by_distance(df: DataFrame, digits: int = 3) -> DataFrame:
    return (df.where("distance_category is not null").groupBy("distance_category")
            .agg(round_even(F.avg("delivery_delay"), digits).alias("avg_delay")))


def orders_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy(month_text("order_date").alias("month")).agg(
        F.count("order_id").alias("orders"))


SUMMARY_SETS = ("split", "is_delayed", "carrier", "destination_region", "product_category",
                "distance_category", "month")
SUMMARY_COLUMNS = ("order_id", "order_date", "is_delayed", "delivery_delay", "carrier",
                   "destination_region", "product_category", "distance_category")


def summary_rows(df: DataFrame, **options) -> DataFrame:
    """The whole summary as (section, label, value) rows, of any length.

    All sections but the delay figures come from one scan.
    """
    marked = with_split(df).withColumn("month", month_text("order_date"))
    totals = group_totals(marked, [[name] for name in SUMMARY_SETS],
                          ("is_delayed", "delivery_delay")).staged()

    def part(section: str, key: str, value: Column, known: bool = True) -> DataFrame:
        rows = totals.by(key)
        rows = rows.where(F.col(key).isNotNull()) if known else rows
        return rows.select(F.lit(section).alias("section"),
                           F.col(key).cast("string").alias("label"),
                           value.cast("double").alias("value"))

    def wide(section: str, table: DataFrame) -> DataFrame:
        table = table.select([F.col(c).cast("double") for c in table.columns])
        return table.unpivot([], table.columns, "label", "value").select(
            F.lit(section).alias("section"), "label", "value")

    def rows_of(split: str | None) -> Column:
        counted = F.col("rows") if split is None else F.when(F.col("split") == split, F.col("rows"))
        return F.coalesce(F.sum(counted), F.lit(0))

    sizes = totals.by("split").agg(rows_of(None).alias("total_rows"),
                                   rows_of("train").alias("train_rows"),
                                   rows_of("test").alias("test_rows"),
                                   F.lit(len(SPLIT_FEATURES)).alias("n_features"))
    known = totals.by("is_delayed").where("is_delayed is not null").agg(F.sum("rows")).scalar()
    parts = [
        wide("size", sizes),
        wide("delivery_delay_stats", delay_stats(df, **options)),
        part("class_balance_is_delayed", "is_delayed", round_even(F.col("rows") / known, 4)),
        part("carrier_on_time_rate", "carrier", round_even(1 - mean("is_delayed"), 4)),
        part("orders_by_region", "destination_region", F.col("rows")),
        part("orders_by_category", "product_category", F.col("rows")),
        part("avg_delay_by_distance_category", "distance_category",
             round_even(mean("delivery_delay"), 3)),
        part("monthly_order_volume", "month", F.col("orders"), known=False),
    ]
    return reduce(DataFrame.unionByName, parts)


def summary_documents(rows: DataFrame) -> DataFrame:
    """The summary as JSON, one object of label to value for each row.

    The shape does not depend on how many labels a section has. The target
    names ride along as a constant.
    """
    entry = F.create_map(F.coalesce("label", F.lit("")), F.col("value"))
    return rows.select("section", "label", F.to_json(entry).alias("document"),
                       F.lit(",".join(SPLIT_TARGETS)).alias("targets"))


# --- dashboard -----------------------------------------------------------

def kpis(df: DataFrame) -> DataFrame:
    """Headline numbers and their display text."""
    row = df.agg(F.count("*").alias("total_orders"),
                 round_even(100 * (1 - F.avg("is_delayed")), 1).alias("on_time_pct"),
                 round_even(F.avg("delivery_delay"), 2).alias("avg_delay"),
                 round_even(F.sum("shipping_cost"), 2).alias("total_cost"))
    return row.select(
        "*", F.format_number("total_orders", 0).alias("total_orders_text"),
        F.concat(F.col("on_time_pct").cast("string"), F.lit("%")).alias("on_time_text"),
        F.concat(F.col("avg_delay").cast("string"), F.lit(" days")).alias("avg_delay_text"),
        F.concat(F.lit("$"), F.format_number("total_cost", 0)).alias("total_cost_text"))


def monthly_trend(df: DataFrame) -> DataFrame:
    return (df.groupBy(month_text("order_date").alias("month"))
            .agg(F.count("order_id").alias("orders"),
                 round_even(F.avg("delivery_delay"), 2).alias("avg_delay"))
            .orderBy("month"))


def carrier_table(df: DataFrame) -> DataFrame:
    return (df.where("carrier is not null").groupBy("carrier")
            .agg(round_even(100 * (1 - F.avg("is_delayed")), 1).alias("on_time_rate"),
                 round_even(F.avg("shipping_cost_per_unit"), 2).alias("avg_cost_per_unit"),
                 F.count("order_id").alias("orders"))
            .orderBy("on_time_rate", "carrier"))


def region_table(df: DataFrame) -> DataFrame:
    return (df.where("destination_region is not null").groupBy("destination_region")
            .agg(round_even(100 * F.avg("is_delayed"), 1).alias("delay_rate"),
                 F.count("order_id").alias("orders"))
            .orderBy(F.col("delay_rate").desc(), "destination_region"))


def align_labels(table: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    """Rows in the order of ``labels``; labels without a row stay, with nulls."""
    order = table.sparkSession.createDataFrame(
        [(name, i) for i, name in enumerate(labels, start=1)], f"{label} string, position int")
    return order.join(table, label, "left").orderBy("position")


def delay_by_distance_ordered(df: DataFrame,
                              labels: Sequence[str] = DISTANCE_LABELS) -> DataFrame:
    return align_labels(delay_by_distance(df, 2), "distance_category", labels)


def top_categories(df: DataFrame, k: int = 7) -> DataFrame:
    counts = (df.where("product_category is not null").groupBy("product_category")
              .agg(F.count("*").alias("orders")))
    return (top_with_rest(counts, "product_category", "orders", k)
            .orderBy("is_rest", F.col("orders").desc(), "product_category"))


# --- carrier rate from tracking events ------------------------------------

def late_event(has_delayed: bool) -> Column:
    """A dedicated DELAYED event where the feed has any, else a "late" reason."""
    if has_delayed:
        return F.coalesce(F.col("event_type") == "DELAYED", F.lit(False))
    return mentions("delay_reason", "late")


def has_delayed_events(events: DataFrame) -> bool:
    return not events.where(F.col("event_type") == "DELAYED").isEmpty()


def late_counts(events: DataFrame) -> DataFrame:
    """Late events of each carrier that has any."""
    late = events.where(late_event(has_delayed_events(events)) & F.col("carrier").isNotNull())
    return late.groupBy("carrier").agg(F.count("*").alias("late"))


def late_counts_all(events: DataFrame) -> DataFrame:
    """Late events of every carrier, 0 for those without any."""
    carriers = events.where("carrier is not null").select("carrier").distinct()
    return carriers.join(late_counts(events), "carrier", "left").select(
        "carrier", F.coalesce("late", F.lit(0)).alias("late"))


def carrier_event_rate(events: DataFrame) -> DataFrame:
    """1 - late events / events, per carrier; counts events, not orders."""
    late = F.sum(late_event(has_delayed_events(events)).cast("bigint"))
    return (events.where("carrier is not null").groupBy("carrier")
            .agg(late.alias("late"), F.count("*").alias("events"))
            .withColumn("on_time_rate", round_even(1 - F.col("late") / F.col("events"), 4)))


# --- exploration ----------------------------------------------------------

def carrier_exploration(train: DataFrame) -> DataFrame:
    return (train.groupBy("carrier")
            .agg(F.count("*").alias("orders"),
                 round_even(1 - F.avg("is_delayed"), 4).alias("on_time_rate"),
                 round_even(F.avg("delivery_delay"), 3).alias("avg_delay_days"),
                 round_even(F.avg("shipping_cost_per_unit"), 2).alias("avg_cost_per_unit"))
            .orderBy(F.col("on_time_rate").desc(), "carrier"))


def distance_exploration(train: DataFrame) -> DataFrame:
    return (train.groupBy("distance_category")
            .agg(F.count("*").alias("orders"),
                 round_even(F.avg("delivery_delay"), 3).alias("avg_delay_days"),
                 round_even(F.avg("route_efficiency_score"), 3).alias("avg_route_efficiency"))
            .orderBy(F.col("avg_delay_days").desc(), "distance_category"))


def describe(df: DataFrame, column: str = "delivery_delay", **options) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum."""
    row = exact_quantiles(df, [], column, [0.25, 0.5, 0.75], **options).first()
    quartiles = row["q"] if row else [None] * 3
    cols = [F.count(column).cast("double").alias("count"),
            round_even(F.avg(column), 3).alias("mean"),
            round_even(F.stddev_samp(column), 3).alias("std"),
            F.min(column).cast("double").alias("min")]
    cols += [round_even(F.lit(q).cast("double"), 3).alias(name)
             for q, name in zip(quartiles, ["p25", "p50", "p75"])]
    return df.agg(*cols, F.max(column).cast("double").alias("max"))


def known_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-missing values of each column."""
    wide = df.agg(*[F.count(c).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "known")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte")]


def correlations(df: DataFrame, target: str = "delivery_delay",
                 skip: Sequence[str] = ("is_delayed",)) -> DataFrame:
    """Pearson correlation of every numeric column with the target, strongest first."""
    columns = [c for c in numeric_columns(df) if c != target and c not in skip]
    wide = df.agg(*[round_even(F.corr(c, target), 3).alias(c) for c in columns])
    return (wide.unpivot([], columns, "feature", "corr_with_delivery_delay")
            .orderBy(F.abs("corr_with_delivery_delay").desc_nulls_last(), "feature"))


def histogram(df: DataFrame, column: str = "delivery_delay", bins: int = 40) -> DataFrame:
    """Equal-width counts with the edges of each bin, empty ones included.

    The last bin includes the maximum. A constant column spreads its bins over
    one unit around the constant; a column without values has no bins.
    """
    ends = df.agg(F.min(column).cast("double").alias("__low"),
                  F.max(column).cast("double").alias("__high"))
    pad = F.when(F.col("__low") == F.col("__high"), 0.5).otherwise(0.0)
    ends = ends.where("__low is not null").select(
        (F.col("__low") - pad).alias("__low"),
        ((F.col("__high") - F.col("__low") + 2 * pad) / bins).alias("__width"))
    one = df.agg(F.struct(F.min(column).cast("double").alias("low"),
                          F.max(column).cast("double").alias("high"))).scalar()
    margin = F.when(one["low"] == one["high"], 0.5).otherwise(0.0)
    value = F.col(column).cast("double")
    index = F.least(F.floor((value - one["low"] + margin)
                            / ((one["high"] - one["low"] + 2 * margin) / bins)), F.lit(bins - 1))
    counts = (df.where(F.col(column).isNotNull())
              .groupBy((index + 1).cast("int").alias("bin")).agg(F.count("*").alias("orders")))
    frame = ends.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "*")
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("__low") + (F.col("bin") - 1) * F.col("__width")).alias("low"),
        (F.col("__low") + F.col("bin") * F.col("__width")).alias("high"),
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percent of rows with a value, per column."""
    wide = df.agg(*[round_even(100 * F.try_divide(F.count(c), F.count("*")), 1).alias(c)
                    for c in columns])
    return wide.unpivot([], list(columns), "column", "populated_pct")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, the same ones on every run: those of the lowest draws.

    A threshold set a little above the wanted share discards most rows before
    the sort, which then sees n rows and some spare.
    """
    total = df.count()
    ranked = df.withColumn("__draw", uniform(key, "sample", seed))
    if total > 4 * n:
        spare = n + 10 * int(n ** 0.5) + 1_000
        near = ranked.where(F.col("__draw") <= min(1.0, spare / total))
        if near.limit(n).count() == n:
            ranked = near
    return ranked.orderBy("__draw", key).limit(n).drop("__draw")


def with_position(ordered: DataFrame) -> DataFrame:
    """Add the place of each row of a small ordered result, from 1."""
    numbered = ordered.withColumn("__at", F.monotonically_increasing_id())
    return numbered.withColumn("position", F.row_number().over(Window.orderBy("__at"))).drop("__at")
