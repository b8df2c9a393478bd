"""Registered queries against their SQL, whole tables at the smallest scale."""

import pytest

duckdb = pytest.importorskip("duckdb")

from haulmetrics.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(prepared, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = QUERIES[name](prepared, sf_dir)
    columns = sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = con.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    assert (sorted(map(tuple, got.select(columns).collect()), key=str)
            == sorted(expected, key=str))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(prepared, sf_dir, name):
    got = QUERIES[name](prepared, sf_dir)
    rows = got.count()
    assert rows == prepared.read.parquet(f"{sf_dir}/documents.parquet").count()
