import random
from pathlib import Path
from statistics import median

import pytest
from pyspark.sql import functions as F

from checks import stages
from haulmetrics.operators.quantiles import counted_median
from haulmetrics.plans import analytics, features, increments
from haulmetrics.schema import FEATURE_COLUMNS
from haulmetrics.session import stage
from haulmetrics.sources import versions

SF = "/root/testdata/sf0.001"


def close(left, right):
    """Equal rows in any order, doubles to nine digits."""
    def shown(df):
        return sorted([tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in row)
                       for row in df.collect()], key=str)
    return shown(left) == shown(right)


@pytest.fixture(scope="module")
def orders(spark):
    """Cleaned orders, some without carrier, category, quantity, region or cost."""
    part = F.pmod(F.xxhash64("order_id"), F.lit(40))
    holes = {"carrier": 0, "product_category": 1, "quantity": 2, "destination_region": 3,
             "shipping_cost": 4}
    rows = stages.clean(spark, SF)
    return stage(rows.withColumns({c: F.when(part != n, F.col(c)) for c, n in holes.items()}),
                 "holes")


@pytest.fixture(scope="module")
def whole(orders):
    return stage(features.engineer_features(orders), "whole")


def third(n):
    return F.month("order_date") % 3 == n


def equals_recount(spark, folder, orders, whole):
    assert close(increments.carrier_month(spark, folder), analytics.carrier_month(whole))
    assert close(increments.region_delays(spark, folder),
                 analytics.region_route(whole).drop("avg_route_efficiency_score"))
    rows = orders.where(third(1))
    got = features.engineer_features(rows, increments.statistics(spark, folder))
    assert close(got.select("order_id", *FEATURE_COLUMNS),
                 whole.where(third(1)).select("order_id", *FEATURE_COLUMNS))


def test_batches_equal_a_recount(spark, tmp_path, orders, whole):
    folder = str(tmp_path / "store")
    for n in range(3):
        assert increments.add_batch(orders.where(third(n)), folder, f"b{n}") == n + 1
    equals_recount(spark, folder, orders, whole)
    # a retry changes nothing
    increments.add_batch(orders.where(third(1)), folder, "b1")
    equals_recount(spark, folder, orders, whole)


def test_batches_may_share_months(spark, tmp_path, orders, whole):
    folder = str(tmp_path / "store")
    half = F.pmod(F.xxhash64("order_id", F.lit(1)), F.lit(2))
    increments.add_batch(orders.where(half == 0), folder, "even")
    increments.add_batch(orders.where(half == 1), folder, "odd")
    equals_recount(spark, folder, orders, whole)


def test_a_corrected_batch_leaves_its_old_months(spark, tmp_path, orders, whole):
    folder = str(tmp_path / "store")
    increments.add_batch(orders.where(~third(2)), folder, "first")
    increments.add_batch(orders, folder, "second")
    increments.add_batch(orders.where(third(0)), folder, "second")
    increments.add_batch(orders.limit(0), folder, "first")
    assert all(int(m[-2:]) % 3 == 0 for m in versions.parts(spark, folder))
    increments.add_batch(orders.where(~third(0)), folder, "third")
    equals_recount(spark, folder, orders, whole)


def test_only_the_months_of_a_batch_are_written(spark, tmp_path, orders):
    folder = str(tmp_path / "store")
    increments.add_batch(orders.where(~third(1)), folder, "old")
    before = versions._manifest(spark, folder)["parts"]
    increments.add_batch(orders.where(third(1)), folder, "new")
    after = versions._manifest(spark, folder)["parts"]
    assert before.items() <= after.items() and len(after) > len(before)
    assert all(Path(folder, path).is_dir() for path in after.values())


def test_partials_are_one_scan(spark, orders):
    plan = increments.partials(orders, "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_empty_store(spark, tmp_path, orders):
    folder = str(tmp_path / "store")
    increments.add_batch(orders.limit(0), folder, "none")
    assert increments.carrier_month(spark, folder).collect() == []
    assert increments.region_delays(spark, folder).collect() == []
    empty = features.engineer_features(orders.limit(0), increments.statistics(spark, folder))
    assert empty.collect() == []
    increments.add_batch(orders.limit(3), folder, "some")
    assert increments.carrier_month(spark, folder).agg(F.sum("order_count")).first()[0] == 3


def test_a_store_that_moved_on_is_not_overwritten(spark, tmp_path, orders):
    folder = str(tmp_path / "store")
    increments.add_batch(orders.where(third(0)), folder, "a")
    late = stage(increments.partials(orders.where(third(1)), "late"), "late")
    increments.add_batch(orders.where(third(2)), folder, "b")
    with pytest.raises(versions.VersionTaken):
        versions.replace_parts(late, folder, since=1)
    assert versions.versions(spark, folder) == [1, 2]


@pytest.mark.parametrize("small", [2, 10, 1_000_000])
@pytest.mark.parametrize("seed", range(3))
def test_counted_median(spark, small, seed):
    draw = random.Random(seed)
    values = [round(draw.lognormvariate(2, 2), 2) for _ in range(draw.choice([700, 701]))]
    values += [values[0]] * draw.choice([1, 400])
    counts = {v: values.count(v) for v in values}
    df = stage(spark.createDataFrame([*counts.items(), (None, 5), (3.0, 0)], "v double, n long"),
               "counts")
    assert counted_median(df, "v", "n", small=small) == pytest.approx(median(values), rel=1e-12)


def test_counted_median_of_nothing(spark):
    df = stage(spark.createDataFrame([(None, 5)], "v double, n long"), "counts")
    assert counted_median(df, "v", "n") is None
