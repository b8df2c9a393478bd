"""Exact quantiles: the bracketed path must agree with a plain sort."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from haulmetrics.operators import quantiles
from haulmetrics.operators.impute import fill_from_groups
from haulmetrics.session import stage

PROBS = [0.25, 0.5, 0.75]


def skewed(spark):
    """One group holds most rows; others are tiny, constant or tied."""
    rng = np.random.default_rng(1)
    frame = pd.concat([
        pd.DataFrame({"g": "big", "v": rng.normal(size=6_000)}),
        pd.DataFrame({"g": "tied", "v": rng.integers(0, 3, 700).astype(float)}),
        pd.DataFrame({"g": "one", "v": [4.5]}),
        pd.DataFrame({"g": "two", "v": [1.0, 2.0]}),
        pd.DataFrame({"g": None, "v": [9.0, 7.0, 8.0]}),
    ])
    return frame, stage(spark.createDataFrame(frame, "g string, v double"), "t")


@pytest.mark.parametrize("small_group,accuracy", [(1_000_000, 10_000), (600, 20)])
def test_matches_sorting(spark, small_group, accuracy):
    frame, df = skewed(spark)
    got = {r["g"]: (r["n"], r["q"]) for r in quantiles.exact_quantiles(
        df, ["g"], "v", PROBS, small_group=small_group, accuracy=accuracy).collect()}
    for g, part in frame.groupby("g", dropna=False):
        n, q = got[None if pd.isna(g) else g]
        assert n == len(part)
        assert q == pytest.approx(part["v"].quantile(PROBS).tolist(), abs=1e-12)


@pytest.mark.parametrize("small_group", [1_000_000, 600])
def test_whole_column(spark, small_group):
    frame, df = skewed(spark)
    got = quantiles.exact_median(df, "v", small_group=small_group, accuracy=50)
    assert got == pytest.approx(frame["v"].median(), abs=1e-12)


@pytest.mark.parametrize("wrong", ["max", "min"])
def test_brackets_that_miss_are_moved(spark, monkeypatch, wrong):
    """First brackets in the wrong place must not change the result."""
    frame, df = skewed(spark)
    real, calls = F.percentile_approx, []

    def sketch(*args):
        calls.append(args)
        return F.array(*[getattr(F, wrong)("__v")] * 6) if len(calls) == 1 else real(*args)

    monkeypatch.setattr(quantiles.F, "percentile_approx", sketch, raising=True)
    got = {r["g"]: r["q"] for r in quantiles.exact_quantiles(
        df, ["g"], "v", PROBS, small_group=3_000, accuracy=100).collect()}
    want = frame[frame["g"] == "big"]["v"].quantile(PROBS).tolist()
    assert got["big"] == pytest.approx(want, abs=1e-12)


def test_no_task_counts_more_than_a_small_group(spark, monkeypatch):
    """With a coarse sketch several rounds are needed before values are counted."""
    rows = spark.range(60_000).select(F.lit("a").alias("g"), F.hash("id").cast("double").alias("v"))
    df, seen, plain = stage(rows, "t"), [], quantiles._counted

    def counted(base, state, *args):
        out = state.select(F.explode("b.light").alias("light"))
        seen.append(out.agg(F.sum("light")).first()[0])
        return plain(base, state, *args)

    monkeypatch.setattr(quantiles, "_counted", counted)
    monkeypatch.setattr(quantiles, "GRID", 10)
    got = quantiles.exact_quantiles(df, [], "v", PROBS, small_group=3_000, accuracy=50).first()["q"]
    want = df.toPandas()["v"].quantile(PROBS).tolist()
    assert got == pytest.approx(want, abs=1e-6) and seen[0] <= 3_000


def test_empty_column(spark):
    df = stage(spark.createDataFrame([(None,)], "v double"), "t")
    assert quantiles.exact_median(df, "v") is None


def test_fill_keeps_observed_and_uses_two_steps(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), ("b", None), (None, 50.0),
            (None, None)]
    df = stage(spark.createDataFrame(rows, "g string, v double"), "t")
    got = sorted((r["g"] or "", r["v"]) for r in fill_from_groups(df, [("v", ["g"])]).collect())
    # a -> 2; the column is then 1, 3, 2, 50 with median 2.5 for b and the missing key.
    assert got == sorted([("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 2.5), ("b", 2.5), ("", 50.0),
                          ("", 2.5)])
