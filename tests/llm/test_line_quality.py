import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import line_quality
from haulmetrics.llm.queries import op5_line_quality


def test_shapes():
    shapes, lengths = line_quality.line_shapes("Ab cd.\n\nwow wow ###\n")
    assert lengths.tolist() == [6, 0, 11, 0]
    assert np.allclose(shapes[0, :5], [3 / 6, 1 / 6, 0, 0, 1 / 6])
    assert np.allclose(shapes[2, 3], 3 / 11) and np.allclose(shapes[2, 10], 1 / 3)
    assert shapes[:, 12].tolist() == [0, 1, 0, 1]


def brute_marginals(odds, stay):
    """By summing over all labellings of the chain."""
    total, good = 0.0, [0.0] * len(odds)
    for labels in itertools.product((0, 1), repeat=len(odds)):
        s = sum(o for o, y in zip(odds, labels) if y)
        s += stay * sum(a == b for a, b in zip(labels, labels[1:]))
        total += math.exp(s)
        for i, y in enumerate(labels):
            good[i] += y * math.exp(s)
    return [g / total for g in good]


@pytest.mark.parametrize("n", [1, 2, 7])
def test_forward_backward(n):
    draw = np.random.default_rng(n)
    shapes = draw.normal(size=(n, line_quality.SHAPES)).astype(np.float32)
    width = line_quality.with_neighbours(shapes).shape[1]
    model = line_quality.LineModel(draw.normal(size=width) / 3,
                                   np.ones(line_quality.SHAPES, np.float32), 0.8)
    odds = (line_quality.with_neighbours(shapes) @ model.weights).tolist()
    assert np.allclose(model.marginals(shapes), brute_marginals(odds, 0.8))


def test_training_climbs_to_the_labels():
    draw = np.random.default_rng(4)
    labels = draw.integers(0, 2, 80)
    chains = [np.hstack([draw.normal(size=(n, 2)) + y, np.ones((n, 1))])
              for y, n in zip(labels, draw.integers(1, 12, 80))]
    w, stay = line_quality.train_chain(chains, labels)
    assert w[0] > 0 and w[1] > 0 and stay > 0.5


GOOD = "This is a line of plain words.\nAnother one follows it, and it ends."
BAD = "$$$ ### %%% BUY!! NOW!!\n&&& *** BUY!! NOW!! ###"


def test_scores(make_docs, prepared):
    rows = [(i, (GOOD if i % 2 else BAD) + f" {i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, GOOD * 3000), (1, GOOD), (1, GOOD),
             (None, BAD), (104, "x" * 200_000)]
    labels = prepared.createDataFrame(
        [(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (5, 1, 0), (999, 1, 1)],
        "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    model = line_quality.fit(docs, labels)
    keep = {"doc_id": F.col("doc_id"), "n": F.length("text")}
    got = line_quality.score(docs, model, keep=keep).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    assert all((score[i] >= 0.7) == bool(i % 2) for i in range(60))
    assert score[103] > 0.7 > score[None] and score[100] == score[101]
    kept = line_quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= 0.7 for r in got)


@pytest.mark.parametrize("marks", [[], [(1, 1, 0)]])
def test_without_labels(make_docs, prepared, marks):
    labels = prepared.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = line_quality.fit(make_docs([(1, "a")]), labels)
    got = line_quality.score(make_docs([(1, "a"), (2, None)]), model, keep={})
    assert [r.score for r in got.collect()] == [0.5, 0.5]
    assert line_quality.score(make_docs([]), model, keep={}).collect() == []


def test_held_out_accuracy(prepared, sf_dir):
    labels = prepared.read.parquet(f"{sf_dir}/labels.parquet")
    got = op5_line_quality(prepared, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93
