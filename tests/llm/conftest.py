import os

import pytest
from pyspark.sql import functions as F

from haulmetrics.llm.common import prepare

#: Columns that tables may have besides, named like what the operators add.
CLASHING = ["score", "size", "target", "taken", "kept", "verdict", "host", "rule", "spans",
            "fingerprint", "start", "n_words", "items", "file", "head", "value", "passes", "part"]


@pytest.fixture(scope="session")
def prepared(spark):
    return prepare(spark)


@pytest.fixture
def make_docs(prepared):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with clashing columns."""
    def make(rows, partitions=3):
        full = [(*r, "en", "src0")[:4] if len(r) == 2 else r for r in rows]
        df = prepared.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return df.repartition(partitions).withColumns(
            {c: F.lit("other") for c in CLASHING})
    return make


@pytest.fixture
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)
