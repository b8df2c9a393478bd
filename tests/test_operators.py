"""Distributed operators against brute force, with hot keys and forced fallbacks."""

import hashlib
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from haulmetrics.operators.attach import attach
from haulmetrics.operators.numbering import number_file_rows, number_rows, page_slice
from haulmetrics.operators.ranking import top_with_rest
from haulmetrics.operators.rolling import rolling_mean
from haulmetrics.plans import mapping
from haulmetrics.session import stage


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "hot_keys": 4},
                                    {"broadcast_rows": 0, "hot_keys": 1}])
def test_attach_is_a_left_join(spark, null_safe, limits):
    keys = ["hot"] * 600 + ["warm"] * 300 + [f"k{i}" for i in range(60)] + [None] * 400
    rows = [(i, k) for i, k in enumerate(keys)]
    df = stage(spark.createDataFrame(rows, "id int, k string"), "t")
    stats = stage(df.groupBy("k").agg(F.count("*").alias("rows"), F.min("id").alias("first"))
                  .where("k is null or k <> 'k7'"), "t")
    out = attach(df, stats, ["k"], weight="rows", null_safe=null_safe, **limits)
    assert out.columns == ["id", "k", "first"]
    first = {}
    for i, k in rows:
        first.setdefault(k, i)
    first.pop("k7")
    if not null_safe:
        first.pop(None)
    got = [(r["id"], r["first"]) for r in out.collect()]
    assert sorted(got, key=lambda pair: pair[0]) == [(i, first.get(k)) for i, k in rows]


def test_attach_two_keys_with_a_value_missing_in_stats(spark):
    df = stage(spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, "b", 2)],
                                     "id int, k string, d int"), "t")
    stats = stage(spark.createDataFrame([("a", 1, 5, None), ("b", 2, 1, 7)],
                                        "k string, d int, rows int, x int"), "t")
    for limits in ({}, {"broadcast_rows": 0, "hot_keys": 2}):
        out = attach(df, stats, ["k", "d"], weight="rows", **limits)
        assert {r["id"]: r["x"] for r in out.collect()} == {1: None, 2: None, 3: 7}


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_row_numbers_do_not_depend_on_partitioning(spark, partitions):
    values = [f"v{i}" for i in range(500)] + ["copy"] * 700
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(partitions)
    got = sorted((r["row_number"], r["v"]) for r in number_rows(df, block=100).collect())
    assert got == list(enumerate(sorted(values, key=_md5), start=1))


def test_pages_cover_everything_once(spark):
    df = spark.createDataFrame([(f"v{i}",) for i in range(1_234)], "v string")
    pages = [[r["v"] for r in page_slice(df, p).collect()] for p in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [500, 500, 234, 0]
    assert len({v for page in pages for v in page}) == 1_234


def _brute_rolling(rows, width):
    groups = {}
    for row_id, group, when, value in rows:
        groups.setdefault(group, []).append((when, _md5(row_id), row_id, value))
    out = {}
    for members in groups.values():
        members.sort(key=lambda m: m[:3])
        for i, member in enumerate(members):
            window = [m[3] for m in members[max(0, i - width + 1):i + 1] if m[3] is not None]
            out[member[2]] = sum(window) / len(window) if window else None
    return out


def _hot_rows():
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(900):  # one carrier: a hot day, in it a hot minute, in it a hot instant
        kind = i % 9
        if kind < 3:
            when = start + timedelta(days=5)
        elif kind < 5:
            when = start + timedelta(days=5, seconds=rng.randrange(60))
        elif kind < 7:
            when = start + timedelta(days=5, seconds=rng.randrange(86_400))
        else:
            when = start + timedelta(days=rng.randrange(30), seconds=rng.randrange(86_400))
        rows.append((f"hot{i}", "hot", when, rng.randrange(-9, 9)))
    for i in range(200):
        rows.append((f"cold{i}", f"c{i % 20}", start + timedelta(hours=rng.randrange(900)),
                     rng.choice([None, 1, 2, 3])))
    rows += [(f"null{i}", None, start + timedelta(days=i), i) for i in range(40)]
    return rows


@pytest.mark.parametrize("chunk_rows", [1_000_000, 300, 50, 7, 1])
@pytest.mark.parametrize("width", [7, 2])
def test_rolling_mean_in_chunks(spark, chunk_rows, width):
    rows = _hot_rows()
    df = stage(spark.createDataFrame(rows, "id string, g string, t timestamp, v int"), "t")
    out = rolling_mean(df, "g", "t", "id", "v", width=width, chunk_rows=chunk_rows)
    assert out.columns == ["id", "g", "t", "v", "rolling_mean"]
    got = {r["id"]: r["rolling_mean"] for r in out.collect()}
    want = _brute_rolling(rows, width)
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value, abs=1e-12)), key


def test_top_with_rest(spark):
    counts = Counter({"a": 9, "b": 9, "Other": 7, "c": 2, "d": 1})
    df = spark.createDataFrame(list(counts.items()), "k string, n int")
    got = {(r["k"], r["is_rest"]): r["n"] for r in top_with_rest(df, "k", "n", 3).collect()}
    assert got == {("a", False): 9, ("b", False): 9, ("Other", False): 7, ("Other", True): 3}
    assert top_with_rest(df, "k", "n", 5).where("is_rest").isEmpty()


def test_numbers_in_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    for name, rows in (("b", range(5, 9)), ("a", range(0, 5)), ("c", [])):
        spark.createDataFrame([(i, "x" * 50) for i in rows], "v int, wide string").coalesce(1) \
            .write.parquet(f"{path}/part={name}")
    got = number_file_rows(spark.read.parquet(path), start=10, name="n")
    assert got.columns == ["v", "wide", "part", "n"]
    assert sorted((r["n"], r["v"]) for r in got.collect()) == [(10 + i, i) for i in range(9)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "RoundRobin" not in plan
    with pytest.raises(ValueError, match="file order"):
        number_file_rows(spark.range(3))


def test_mapping_in_file_order(spark):
    df = stage(spark.createDataFrame([(f"2024-01-{i:02d}", f"c{i}") for i in range(1, 21)],
                                     "order_date string, carrier string").coalesce(1), "feed")
    got = mapping.map_to_schema(df, order="file").select("order_id", "customer_id", "carrier").collect()
    assert sorted(map(tuple, got)) == [
        (f"ORD-{i:07d}", f"CUST-{i - 1:05d}", f"c{i}") for i in range(1, 21)]
    assert {r[0] for r in mapping.map_to_schema(df).select("order_id").collect()} == {r[0] for r in got}
