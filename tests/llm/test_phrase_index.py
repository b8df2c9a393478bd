import random
import re

import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import phrase_index

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, width=10):
    windows = {}
    for key, text in items:
        w = brute_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(str(key))
    out = []
    for key, text, *_ in docs:
        w, hit, found = brute_words(text), set(), set()
        for phrase, owners in windows.items():
            for i in range(len(w) - len(phrase) + 1):
                if tuple(w[i:i + len(phrase)]) == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    found |= owners
        out.append((key, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [3, phrase_index.BLOCK_PHRASES])
def test_matches_brute_force(make_docs, prepared, monkeypatch, block):
    monkeypatch.setattr(phrase_index, "BLOCK_PHRASES", block)
    monkeypatch.setattr(phrase_index.search, "__kwdefaults__", {"slop": 0, "block": block})
    draw = random.Random(2)
    vocabulary = ["a", "b", "The", "ÉCOLE", "x1", "🙂"]
    text = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(1, text(14)), (2, text(10)), (10, "a b"), (3, "a"), (4, None), (5, ""), (6, "-- ++"),
             (7, text(14)), (1, text(12)), (None, "b The")]
    passage = items[0][1]
    docs = [(i, text(draw.randint(0, 40))) for i in range(60)]
    docs += [(100, f"start {passage} {passage}!"), (101, passage.lower().replace(" ", "\n--")),
             (102, None), (103, ""), (104, "?!"), (105, "a"), (106, "zz"), (105, "a"), (None, "a b"),
             (107, "w " * 30_000 + passage), (108, "a " * 300)]
    table = prepared.createDataFrame(items, "item_id long, text string").withColumn(
        "n_hit", F.lit("other"))
    found = phrase_index.contamination(make_docs(docs), table)
    expected = [(k, n, h, sorted(i for i in items_ if i != "None"))
                for k, n, h, items_ in brute(docs, items)]
    assert sorted(((r[0], r[1], r[2], list(r[3])) for r in found.collect()), key=str) == expected


def test_documents_do_not_run_into_each_other(make_docs, prepared):
    docs = [(i, "one two three") for i in range(20)]
    items = prepared.createDataFrame([(1, "three one")], "item_id long, text string")
    assert all(r.n_hit == 0 for r in phrase_index.contamination(make_docs(docs, 1), items).collect())


def test_proximity(make_docs, prepared):
    docs = [(1, "x quick brown fox y"), (2, "quick and brown fox"), (3, "fox quick brown"),
            (4, "quick then very brown old fox"), (5, "quick brown")]
    index = phrase_index.build_index(make_docs(docs, 1))
    phrases = prepared.createDataFrame([(1, bytearray(b"quick brown fox"))],
                                       "phrase_id long, phrase binary")

    def found(slop):
        rows = phrase_index.search(index, phrases, slop=slop)
        named = phrase_index.document_rows(index).join(rows, ["__segment", "__row"])
        return sorted({r["__key"] for r in named.collect()})
    assert found(0) == [1]
    assert found(1) == [1, 2]
    assert found(2) == [1, 2]
    assert found(3) == [1, 2, 3, 4]


def test_empty_tables(make_docs, prepared):
    none = prepared.createDataFrame([], "item_id long, text string")
    assert phrase_index.contamination(make_docs([]), none).collect() == []
    assert [tuple(r)[1:3] for r in phrase_index.contamination(make_docs([(1, "a b")]), none).collect()] \
        == [(2, 0)]
