"""Every registered query against its SQL counterpart, whole tables at the smallest scale."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_module  # noqa: E402
from checks import registry  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def _sorted_rows(rows):
    rows = [tuple(_plain(v) for v in row) for row in rows]
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0)
                                         for v in row])


FORBIDDEN = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"]


def _check_plan(df):
    """Equi-joins only, nothing leaves the JVM."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    _check_plan(df)
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {quoted} FROM ({ORACLES[name]})")
    assert columns == sorted(duck.sql(ORACLES[name]).columns)
    assert _sorted_rows(df.select(columns).collect()) == _sorted_rows(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    _check_plan(df)
    assert df.count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_sample_is_repeatable(spark):
    first, second = (sorted(r[0] for r in QUERIES["t07_seeded_sample"](spark, SF_DIR).collect())
                     for _ in range(2))
    assert first == second
