"""Every stage against a brute-force version, and its edge cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from haulmetrics.llm import line_quality, simhash, source_mix
from tests.llm.test_line_quality import BAD, GOOD
from tests.llm.test_phrase_index import brute as brute_windows
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_source_mix import brute_sizes

STAGES = dict(corpus_pipeline.STAGES)


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))


@pytest.fixture
def tables(prepared, tmp_path):
    draw = random.Random(8)
    labels = [(i, i % 2, 0) for i in range(40)]
    prepared.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    items = [(1, words(draw, 14)), (2, words(draw, 10)), (3, None)]
    prepared.createDataFrame(items, "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    long = words(draw, 300)
    rows = [(i, f"{GOOD if i % 2 else BAD} {words(draw, 12)}", "en", f"src{i % 3}") for i in range(40)]
    rows += [(50, long, "en", "src0"), (51, long, "de", "src1"), (51, long, "de", "src1"),
             (49, long + " tail", "en", None), (None, long, "en", "src2"), (None, None, "en", "src2"),
             (60, f"{GOOD} {items[0][1]}", "en", "src0"), (61, f"{words(draw, 30)}. {items[1][1]}", "fr", "x"),
             (70, "", "en", "src1"), (71, None, "en", "src1"), (8, GOOD + " same key", "en", "src2")]
    docs = prepared.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.repartition(3).withColumns({c: F.lit("other") for c in (
        "score", "size", "passes", "n_hit", "items", "start", "component_id")})
    return str(tmp_path), docs, rows, items


def plain(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source").collect()), key=str)


def test_quality(prepared, tables):
    path, docs, rows, _ = tables
    got = STAGES["quality"](prepared, docs, path)
    model = line_quality.fit(docs, prepared.read.parquet(f"{path}/labels.parquet"))
    assert got.columns == docs.columns
    assert plain(got) == sorted([r for r in rows if model.score(r[1]) >= 0.7], key=str)
    assert {r[0] for r in plain(got)} >= set(range(1, 40, 2))


def test_near_dedup(prepared, tables):
    path, docs, rows, _ = tables
    got = STAGES["near_dedup"](prepared, docs, path)
    root = brute_components([brute_fingerprint(r[1], simhash.SHINGLE) for r in rows],
                            simhash.DISTANCE)
    first = {}
    for r, group in zip(rows, root):
        if group not in first or (r[0] is None, r[0]) < (first[group][0] is None, first[group][0]):
            first[group] = r
    assert got.columns == docs.columns
    found = plain(got)
    assert len(found) == len(first)
    assert [r[0] for r in found] == [r[0] for r in sorted(first.values(), key=str)]


def test_decontaminate(prepared, tables):
    path, docs, rows, items = tables
    got = STAGES["decontaminate"](prepared, docs, path)
    hit = {r[0] for r in brute_windows(rows, items) if r[2]}
    assert hit == {60, 61} and got.columns == docs.columns
    assert plain(got) == sorted([r for r in rows if r[0] not in hit], key=str)


def test_mix(prepared, tables):
    path, docs, rows, _ = tables
    got = STAGES["mix"](prepared, docs, path)
    assert got.columns == docs.columns
    taken = plain(got)
    assert taken == plain(STAGES["mix"](prepared, docs.repartition(7), path))
    assert set(taken) <= set(rows)
    assert all(taken.count(r) <= 2 * rows.count(r) for r in set(rows))
    sizes = brute_sizes(rows)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    total = [sum(n for _, n in sizes[s]) for s in names]
    targets = source_mix.capped_targets(total, source_mix.cycled(corpus_pipeline.WEIGHTS)(names), 1.5, 2)
    got_sizes = brute_sizes(taken)
    for name, target in zip(names, targets):
        longest = max(n for _, n in sizes[name])
        assert abs(sum(n for _, n in got_sizes.get(name, [])) - target) <= longest + 64


def test_tokens(prepared, tables):
    path, docs, rows, _ = tables
    got = STAGES["token_shards"](prepared, docs, path).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    crc = sorted((str(r[0]), zlib.crc32(np.array(tokenizer.encode(
        r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for r in rows)
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == crc


def test_empty_tables(prepared, tables, tmp_path):
    path, docs, *_ = tables
    none = docs.limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(prepared, none, path).collect() == []


def test_run(prepared, tables):
    path, docs, *_ = tables
    docs.write.parquet(f"{path}/documents.parquet")
    step = docs
    for _, fn in corpus_pipeline.STAGES:
        step = fn(prepared, step, path)
    assert sorted(map(str, corpus_pipeline.run(prepared, path).collect())) == \
        sorted(map(str, step.collect()))
