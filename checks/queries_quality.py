"""Data quality (Q01-Q11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as S, stages
from checks.registry import query
from haulmetrics.plans import quality
from haulmetrics.schema import FEATURE_COLUMNS
from haulmetrics.sources.tables import require_nonempty

_SHOWN = ["rule", "success", "element_count", "unexpected_count"]


def _quote(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _bad(rule: quality.Rule) -> str:
    c = rule.column
    if rule.kind == quality.NOT_NULL:
        return f"{c} IS NULL"
    if rule.kind == quality.IN_SET:
        return f"{c} NOT IN ({', '.join(map(_quote, rule.args['values']))})"
    if rule.kind == quality.BETWEEN:
        return f"{c} NOT BETWEEN {rule.args['min']} AND {rule.args['max']}"
    return f"NOT regexp_full_match({c}, '{rule.args['regex'].strip('^$')}')"


def _rule_sql(rule: quality.Rule) -> str:
    c = rule.column
    if rule.kind == quality.UNIQUE:
        bad = (f"(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM featured"
               f" WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))")
    elif rule.kind == quality.MEAN_BETWEEN:
        return (f"SELECT '{rule.name}' AS rule, avg({c}) BETWEEN {rule.args['min']} AND"
                f" {rule.args['max']} AS success, count({c}) AS element_count,"
                f" NULL::BIGINT AS unexpected_count FROM featured")
    else:
        bad = f"count(*) FILTER ({_bad(rule)})"
    elements = "count(*)" if rule.kind == quality.NOT_NULL else f"count({c})"
    return (f"SELECT '{rule.name}' AS rule, {bad} = 0 AS success, {elements} AS element_count,"
            f" {bad} AS unexpected_count FROM featured")


def _suite_sql(suite) -> str:
    return S.with_(S.FEATURED, "\nUNION ALL ".join(map(_rule_sql, suite)))


def _kind(name: str, kind: str) -> None:
    suite = [rule for rule in quality.ORDER_SUITE if rule.kind == kind]

    @query(name, _suite_sql(suite))
    def run(spark, sf):
        rows = stages.featured(spark, sf, *quality.columns_of(suite))
        return quality.compile_rules(rows, suite).select(*_SHOWN)


_kind("q01_unique", quality.UNIQUE)
_kind("q02_not_null", quality.NOT_NULL)
_kind("q03_in_set", quality.IN_SET)
_kind("q04_between", quality.BETWEEN)
_kind("q05_matches", quality.MATCHES)


@query("q06_mean_between", S.with_(S.FEATURED, f"""
SELECT 'is_delayed:mean_between' AS rule, avg(is_delayed) BETWEEN 0 AND 0.6 AS success,
  {S.r('avg(is_delayed)', 6)} AS observed_value FROM featured"""))
def mean_between(spark, sf):
    suite = [rule for rule in quality.ORDER_SUITE if rule.kind == quality.MEAN_BETWEEN]
    return quality.compile_rules(stages.featured(spark, sf), suite).select(
        "rule", "success", "observed_value")


@query("q07_suite_from_json", _suite_sql(quality.ORDER_SUITE))
def suite_from_json(spark, sf):
    """The suite stored as an expectation suite, read back and run."""
    suite = quality.suite_from_expectations(quality.suite_to_expectations(quality.ORDER_SUITE))
    return quality.compile_rules(stages.featured(spark, sf), suite).select(*_SHOWN)


@query("q08_validate", _suite_sql(quality.ORDER_SUITE))
def validate(spark, sf):
    return quality.validate(stages.featured(spark, sf)).select(*_SHOWN)


_REPORT = S.FEATURED + ",\nchecks AS (" + "\nUNION ALL ".join(
    map(_rule_sql, quality.ORDER_SUITE)) + ")"


@query("q09_report", S.with_(_REPORT, f"""
SELECT (SELECT count(*) FROM featured) AS dataset_rows, 37 AS dataset_columns,
  count(*) AS total_expectations, count(*) FILTER (success) AS passed,
  count(*) FILTER (NOT success) AS failed,
  {S.r('100 * count(*) FILTER (success) / count(*)', 2)} AS success_rate_pct,
  bool_and(success) AS overall_success,
  coalesce(string_agg(rule || ' ' || unexpected_count, ', ' ORDER BY rule)
           FILTER (NOT success), '') AS failed_rules FROM checks"""))
def report(spark, sf):
    df = stages.featured(spark, sf)
    summary = quality.report(quality.validate(df), len(df.columns))
    failed = F.from_json("failed_expectations",
                         "array<struct<kind:string,column:string,unexpected_count:bigint>>")
    named = F.transform(failed, lambda x: F.concat(x["column"], F.lit(":"), x["kind"], F.lit(" "),
                                                   x["unexpected_count"]))
    return summary.withColumn("failed_rules", F.array_join(F.array_sort(named), ", ")) \
        .drop("failed_expectations")


@query("q10_pass_rate_gate", S.with_(_REPORT, f"""
SELECT {S.r('100 * count(*) FILTER (success) / count(*)', 2)} AS success_rate_pct FROM checks"""))
def pass_rate_gate(spark, sf):
    df = stages.featured(spark, sf, *quality.columns_of(quality.ORDER_SUITE))
    width = len(stages.clean(spark, sf).columns) + len(FEATURE_COLUMNS)
    summary = quality.report(quality.validate(df), width)
    return quality.require_pass_rate(summary, 90.0).select("success_rate_pct")


@query("q11_nonempty_gate", S.with_(S.CLEAN, """
SELECT count(*) AS n, (SELECT count(*) FROM shipments_raw) AS extracted FROM clean"""))
def nonempty_gate(spark, sf):
    raw = require_nonempty(stages.raw(spark, sf), "extract")
    cleaned = require_nonempty(stages.clean(spark, sf), "clean")
    extracted = raw.agg(F.count("*")).scalar()
    return cleaned.agg(F.count("*").alias("n")).withColumn("extracted", extracted)
