"""Declared data-quality rules, run in one aggregation, with report and gate."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetrics.functions.numeric import round_even
from haulmetrics.plans.clean import counted_rows
from haulmetrics.schema import (DISTANCE_LABELS, PRIMARY_SOURCE, SECOND_SOURCE, SHIPPING_MODES,
                                SIZE_LABELS)

UNIQUE, NOT_NULL, IN_SET, BETWEEN, MATCHES, MEAN_BETWEEN = (
    "unique", "not_null", "in_set", "between", "matches", "mean_between")


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    args: dict = field(default_factory=dict)
    severity: str = "critical"

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"


def between(column: str, low: float, high: float) -> Rule:
    return Rule(BETWEEN, column, {"min": low, "max": high})


def in_set(column: str, values: Sequence[str]) -> Rule:
    return Rule(IN_SET, column, {"values": list(values)})


# --- fixed values: the 21 rules of the orders suite -----------------------
ORDER_SUITE = [
    Rule(UNIQUE, "order_id"),
    Rule(NOT_NULL, "order_id"),
    Rule(NOT_NULL, "order_date"),
    Rule(NOT_NULL, "carrier"),
    in_set("source_system", [PRIMARY_SOURCE, SECOND_SOURCE]),
    in_set("shipping_mode", SHIPPING_MODES),
    between("quantity", 1, 1000),
    between("unit_price", 0, 10000),
    between("shipping_cost", 0, 5000),
    between("destination_latitude", -90, 90),
    between("destination_longitude", -180, 180),
    between("distance_km", 0, 25000),
    between("promised_delivery_days", 0, 180),
    between("actual_delivery_days", 0, 240),
    Rule(MATCHES, "order_id", {"regex": r"^ORD-(OLIST-)?\d+$"}),
    between("carrier_performance_score", 0, 1),
    between("route_efficiency_score", 0, 1),
    between("reorder_risk_score", 0, 1),
    in_set("distance_category", DISTANCE_LABELS),
    in_set("shipment_size_category", SIZE_LABELS),
    Rule(MEAN_BETWEEN, "is_delayed", {"min": 0.0, "max": 0.6}),
]


def suite_to_json(suite: Sequence[Rule]) -> str:
    return json.dumps([asdict(rule) for rule in suite], indent=2)


def suite_from_json(text: str) -> list[Rule]:
    return [Rule(**entry) for entry in json.loads(text)]


#: Rule types of stored expectation suites, and the names of their arguments.
EXPECTATIONS = {
    "expect_column_values_to_be_unique": UNIQUE,
    "expect_column_values_to_not_be_null": NOT_NULL,
    "expect_column_values_to_be_in_set": IN_SET,
    "expect_column_values_to_be_between": BETWEEN,
    "expect_column_values_to_match_regex": MATCHES,
    "expect_column_mean_to_be_between": MEAN_BETWEEN,
}
EXPECTATION_ARGS = {"value_set": "values", "min_value": "min", "max_value": "max",
                    "regex": "regex"}


def suite_from_expectations(text: str) -> list[Rule]:
    """Rules of a stored suite: entries of ``type``, ``kwargs`` and ``severity``."""
    rules = []
    for entry in json.loads(text)["expectations"]:
        args = dict(entry["kwargs"])
        column = args.pop("column")
        rules.append(Rule(EXPECTATIONS[entry["type"]], column,
                          {EXPECTATION_ARGS[k]: v for k, v in args.items()},
                          entry.get("severity", "critical")))
    return rules


def suite_to_expectations(suite: Sequence[Rule], name: str = "orders") -> str:
    types = {kind: name for name, kind in EXPECTATIONS.items()}
    names = {ours: theirs for theirs, ours in EXPECTATION_ARGS.items()}
    return json.dumps({"name": name, "expectations": [
        {"type": types[r.kind], "severity": r.severity,
         "kwargs": {"column": r.column, **{names[k]: v for k, v in r.args.items()}}}
        for r in suite]}, indent=2)


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def violates(rule: Rule) -> Column:
    """Row test for one rule; missing values pass all but ``not_null``."""
    column = F.col(rule.column)
    if rule.kind == NOT_NULL:
        return column.isNull()
    if rule.kind == IN_SET:
        return ~column.isin(rule.args["values"])
    if rule.kind == BETWEEN:
        return ~column.between(rule.args["min"], rule.args["max"])
    if rule.kind == MATCHES:
        return ~column.rlike(rule.args["regex"])
    raise ValueError(f"no row test for rule kind {rule.kind}")


def repeated_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows carry a known value that occurs more than once.

    The hashes of all values are counted, and the values themselves where a hash repeats.
    """
    counts = counted_rows(df.where(F.col(column).isNotNull()).select(column))
    return counts.where("__copies > 1").agg(F.coalesce(F.sum("__copies"), F.lit(0))
                                            .alias("repeated"))


def columns_of(suite: Sequence[Rule]) -> list[str]:
    """The columns that the rules read."""
    return list(dict.fromkeys(rule.column for rule in suite))


def compile_rules(df: DataFrame, suite: Sequence[Rule]) -> DataFrame:
    """One row per rule from a single pass over ``df``.

    Uniqueness needs its own grouping and comes in as a scalar subquery, for which a stored
    ``df`` is read again.
    """
    measures, results = [F.count("*").alias("rows")], []
    for i, rule in enumerate(suite):
        measures.append(F.count(rule.column).alias(f"known{i}"))
        if rule.kind == MEAN_BETWEEN:
            measures.append(F.avg(rule.column).alias(f"bad{i}"))
        elif rule.kind != UNIQUE:
            measures.append(_count(violates(rule)).alias(f"bad{i}"))
    for i, rule in enumerate(suite):
        base = F.col("rows") if rule.kind == NOT_NULL else F.col(f"known{i}")
        observed = F.lit(None).cast("double")
        if rule.kind == MEAN_BETWEEN:
            observed = F.col(f"bad{i}")
            bad = F.lit(None).cast("bigint")
            ok = F.coalesce(observed.between(rule.args["min"], rule.args["max"]), F.lit(False))
        else:
            bad = repeated_rows(df, rule.column).scalar() if rule.kind == UNIQUE \
                else F.col(f"bad{i}")
            ok = bad == 0
        results.append(F.struct(
            F.lit(i + 1).alias("position"), F.lit(rule.name).alias("rule"),
            F.lit(rule.kind).alias("kind"), F.lit(rule.column).alias("column"),
            F.lit(json.dumps(rule.args)).alias("args"), F.lit(rule.severity).alias("severity"),
            ok.alias("success"), base.alias("element_count"), bad.alias("unexpected_count"),
            round_even(100 * F.try_divide(bad, base), 4).alias("unexpected_percent"),
            round_even(observed, 6).alias("observed_value"), F.col("rows").alias("dataset_rows")))
    return df.agg(*measures).select(F.inline(F.array(*results)))


def validate(df: DataFrame, suite: Sequence[Rule] = ORDER_SUITE) -> DataFrame:
    """Run a suite over a whole table."""
    return compile_rules(df, suite)


def report(checks: DataFrame, dataset_columns: int) -> DataFrame:
    """One summary row of ``validate`` output."""
    failed = F.filter(F.array_sort(F.collect_list(F.when(~F.col("success"), F.struct(
        "position", "kind", "column", "args", "unexpected_count", "unexpected_percent")))),
        lambda x: x.isNotNull())
    passed = F.sum(F.col("success").cast("bigint"))
    return checks.agg(
        F.max("dataset_rows").alias("dataset_rows"),
        F.lit(dataset_columns).alias("dataset_columns"),
        F.count("*").alias("total_expectations"), passed.alias("passed"),
        (F.count("*") - passed).alias("failed"),
        round_even(100 * F.try_divide(passed, F.count("*")), 2).alias("success_rate_pct"),
        F.min("success").alias("overall_success"),
        F.to_json(failed).alias("failed_expectations"))


def require_pass_rate(summary: DataFrame, threshold: float = 90.0) -> DataFrame:
    """Gate: stop when too few rules pass."""
    row = summary.first()
    if row is None or row["success_rate_pct"] is None or row["success_rate_pct"] < threshold:
        rate = row["success_rate_pct"] if row else None
        raise ValueError(f"data quality gate failed: {rate}% of rules passed "
                         f"(threshold {threshold}%)")
    return summary
