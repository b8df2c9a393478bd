"""Ranked search against scores computed for every document."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import ranked_search
from tests.llm.conftest import rows_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=10):
    found = [(key, TERM.findall((text or "").translate(LOWER))) for key, text in docs]
    n_docs = sum(bool(t) for _, t in found)
    total = sum(len(t) for _, t in found)
    df = {}
    for _, words in found:
        for w in set(words):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        wanted = set(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for key, words in found:
            score = 0
            for w in wanted & set(words):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                m = 100 - 90 + (90 * len(words) * n_docs) // total
                tf = words.count(w)
                score += weight * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, key, -score))
    return sorted(out, key=str)


def corpus(draw, n):
    words = ["the", "of", "in", *["w%d" % i for i in range(60)], "É", "中文", "A1"]
    weight = [30, 20, 10, *[60 // (i + 1) + 1 for i in range(60)], 2, 2, 2]
    return [(i, " ".join(draw.choices(words, weight, k=draw.choice([0, 1, 5, 30, 200]))))
            for i in range(n)]


ITEMS = [(1, "the of w1 W2 w59"), (2, "É 中文 a1. w3,w3"), (3, None), (4, ""), (5, "nowhere"),
         (6, "The the THE"), (6, "w40 w41"), (None, "w5 w6 w7 in"), (8, "w1"), (9, "...!?")]


def make_items(prepared, items=ITEMS):
    return prepared.createDataFrame(items, "item_id long, text string").withColumns(
        {c: F.lit("other") for c in ("rank", "score", "doc_id", "terms")})


@pytest.mark.parametrize("segment_bytes", [1, 3000, 1 << 24])
def test_equals_brute_force(prepared, make_docs, segment_bytes):
    rows = corpus(random.Random(segment_bytes), 150)
    rows += [(None, "w5 w6 w7 the"), (None, None), (200, ""), (7, rows[7][1]), (7, rows[7][1])]
    docs = make_docs(rows)
    index = ranked_search.build_index(docs, segment_bytes=segment_bytes)
    assert rows_of(ranked_search.search(index, make_items(prepared))) == brute(rows, ITEMS)
    small = ranked_search.search(index, make_items(prepared), top=3, block_bytes=20)
    assert small.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(small) == brute(rows, ITEMS, 3)


def test_ties_go_by_key(prepared, make_docs):
    """Copies of one text hold most rows; the smallest keys of equal scores win."""
    rows = [(i, "same words here") for i in range(300, 0, -1)] + [(500, "words"), (501, "other")]
    index = ranked_search.build_index(make_docs(rows, 5), segment_bytes=400)
    items = [(1, "same words"), (2, "other")]
    got = rows_of(ranked_search.search(index, make_items(prepared, items)))
    assert got == brute(rows, items)
    assert [r[2] for r in sorted(got) if r[0] == 1] == [500, *range(1, 10)] or \
        [r[2] for r in sorted(got) if r[0] == 1] == list(range(1, 11))


def test_few_intervals_are_split(make_docs, monkeypatch):
    """A rare term leaves most documents unscored."""
    rows = [(i, "the of in " * 5) for i in range(2000)] + [(3000, "the rare"), (3001, "rare the of")]
    texts = [t.encode() for _, t in rows]
    import pyarrow as pa
    batch = ranked_search._segment(pa.array([k for k, _ in rows]), texts)
    row = {c: batch[c][0].as_py() for c in ("__keys", *ranked_search.COLUMNS)}
    wanted = {b"the": 0, b"rare": 1}
    segment = ranked_search.Segment(row, wanted, np.array([1, 7000]), 2002, 30005)
    scored = []
    plain = segment._scored
    monkeypatch.setattr(segment, "_scored", lambda first, docs, *a: scored.extend(docs) or
                        plain(first, docs, *a))
    best = segment.search(np.array([0, 1]), [], 2)
    assert [b[2] for b in best] == [3000, 3001] and len(scored) < 100


def test_text_keys(prepared, make_docs):
    rows = [("b", "w1 w2"), ("a", "w1 w2"), (None, "w1 w2"), ("c", "w9")]
    docs = prepared.createDataFrame(rows, "name string, body string")
    index = ranked_search.build_index(docs, key="name", text="body")
    got = ranked_search.search(index, make_items(prepared, [(1, "w1")])).orderBy("rank")
    assert [r["name"] for r in got.collect()] == ["a", "b", None]


def test_empty_tables(prepared, make_docs):
    docs, items = make_docs([(1, "w1 w2")]), make_items(prepared)
    full = ranked_search.build_index(docs)
    assert ranked_search.search(full, items.limit(0)).collect() == []
    none = ranked_search.build_index(docs.limit(0))
    assert ranked_search.search(none, items).collect() == []
    blank = ranked_search.build_index(make_docs([(1, None), (2, "..")]))
    assert ranked_search.search(blank, items).collect() == []
