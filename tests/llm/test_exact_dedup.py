import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import exact_dedup
from haulmetrics.llm.common import crc32_mod


def brute(rows):
    groups = {}
    for key, text, *_ in rows:
        groups.setdefault(text or "", []).append(key)
    out = []
    for key, text, *_ in rows:
        keys = groups[text or ""]
        keep = max((k for k in keys if k is not None), default=None)
        out.append((key, keep, len(keys), key == keep,
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "a"), (2, "a"), (3, "a "), (4, None), (5, ""), (6, "Ä" * 50_000), (7, "Ä" * 50_000),
        (8, "b"), (8, "b"), (9, "c"), (9, "d"), (None, "e"), (10, "e"), (None, "f"), (11, "lone")]


@pytest.mark.parametrize("digest_bytes", [32, 1])
@pytest.mark.parametrize("limit", [exact_dedup.MAX_BROADCAST_BYTES, 0])
def test_matches_brute_force(make_docs, digest_bytes, limit):
    """One-byte digests make different texts share a digest."""
    draw = random.Random(1)
    rows = ROWS + [(i, draw.choice("xyz") * draw.randint(1, 200)) for i in range(100, 500)]
    found = exact_dedup.dedup(make_docs(rows), crc32_mod("doc_id", 2) == 0,
                              digest_bytes=digest_bytes, broadcast_bytes=limit)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("flag", ["true", "false", "cast(null AS boolean)"])
def test_any_split(make_docs, flag):
    found = exact_dedup.dedup(make_docs(ROWS), F.expr(flag))
    assert sorted(map(tuple, found.collect()), key=str) == brute(ROWS)


def test_empty_table(make_docs):
    assert exact_dedup.dedup(make_docs([]), F.lit(True)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 200_000])
def test_filter_has_no_false_negative(n):
    draw = np.random.default_rng(n)
    keys = draw.integers(0, 2 ** 64, n, dtype=np.uint64)
    made = exact_dedup.FuseFilter.build(keys)
    assert made.contains(keys).all()
    others = draw.integers(0, 2 ** 64, 100_000, dtype=np.uint64)
    assert made.contains(others).mean() < 0.006
    if n >= 200_000:
        assert len(made.slots) * 8 < 10 * n
