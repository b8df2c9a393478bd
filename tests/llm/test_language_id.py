import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmetrics.llm import language_id
from haulmetrics.llm.queries import op2_language_id


def test_ngrams_are_those_of_the_whole_text(monkeypatch):
    text = "Straße ÉCOLE 😀 abc İ " * 40
    whole = language_id.term_counts(text)
    n = len(text.lower())
    assert whole.sum() == n + (n - 1) + (n - 2)
    monkeypatch.setattr(language_id, "WINDOW", 50)
    plain = text.replace("İ", "I")
    small = language_id.term_counts(plain)
    monkeypatch.setattr(language_id, "WINDOW", 1 << 18)
    assert (small == language_id.term_counts(plain)).all()


def test_penalty_leaves_weights_at_zero():
    draw = np.random.default_rng(1)
    rows = []
    for i in range(300):
        y = i % 2
        ids = np.array([y, 2 + draw.integers(50), language_id.DIM])
        rows.append((np.unique(ids), np.ones(len(np.unique(ids))), y))
    w = language_id.ftrl(rows, 2, alpha=0.3, beta=1.0, l1=1.0, l2=1e-3, epochs=3)
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 > w[1, 0]
    assert (w[2:52] == 0).mean() > 0.9 and (w[52:language_id.DIM] == 0).all()


def test_calibration_finds_the_temperature():
    draw = np.random.default_rng(2)
    true = draw.normal(size=(20_000, 3))
    p = np.exp(true) / np.exp(true).sum(axis=1, keepdims=True)
    labels = np.array([draw.choice(3, p=row) for row in p])
    assert abs(language_id.calibrate(true * 4, labels) - 4) < 0.3
    assert language_id.calibrate(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


ROWS = ([(i, "the cat sat on the mat and this is that", "en", "s") for i in range(40)]
        + [(i, "der hund und die katze ist nicht schön", "de", "s") for i in range(40, 80)]
        + [(80, None, "de", "s"), (81, "", "en", "s"), (82, "12 34 !?", "en", "s"),
           (83, "the cat", None, "s"), (None, "die katze und der hund", "de", "s"),
           (1, "the mat", "en", "s"), (1, "the mat", "en", "s"), (84, "x" * 300_000 + "the", None, "s")])


def test_predictions(make_docs):
    docs = make_docs(ROWS).withColumn("lang_pred", F.lit(1))
    model = language_id.fit(docs, sample_rows=1000)
    got = language_id.predict(docs, model, keep={"n": F.length("text")}).collect()
    assert len(got) == len(ROWS)
    by_key = {r.doc_id: r for r in got}
    assert all((by_key[k].lang_pred, by_key[k].score) == ("und", 0.0) for k in (80, 81, 82))
    assert by_key[0].lang_pred == "en" and by_key[50].lang_pred == "de"
    assert by_key[83].lang_pred == "en" and by_key[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got)
    again = language_id.predict(docs.repartition(5), language_id.fit(docs.repartition(2)))
    assert sorted((str(r.doc_id), r.lang_pred) for r in again.collect()) == \
        sorted((str(r.doc_id), r.lang_pred) for r in got)


def test_rare_languages_are_learned(make_docs):
    rows = ([(i, f"the cat sat on the mat and this is {i}", "en", "s") for i in range(3000)]
            + [(5000 + i, f"kissa istui matolla ja tämä on {i}", "fi", "s") for i in range(6)]
            + [(6000, "жив и здоров", "ru", "s")])
    model = language_id.fit(make_docs(rows), sample_rows=60)
    assert model.languages == ["en", "fi", "ru"]
    assert model.predict("kissa istui matolla ja tämä on")[0] == "fi"
    assert model.predict("жив и здоров")[0] == "ru"
    assert model.predict("the cat sat on the mat")[0] == "en"


def test_quota():
    assert language_id.quota([3000, 6, 1], 60) == 53
    assert language_id.quota([5, 5], 60) == 5
    assert language_id.quota([9, 9, 9], 2) == 1
    assert language_id.quota([], 60) == 1


def test_frequencies_cover_all_rows(make_docs):
    df, rows = language_id.document_frequencies(
        make_docs([(i, "a" if i % 2 else "b") for i in range(501)]).select(
            F.col("text").alias("__text")))
    assert rows == 501 and sorted(df[df > 0].tolist()) == [250, 251]


@pytest.mark.parametrize("rows", [[], [(1, "text without label", None, "s")]])
def test_without_training_rows(make_docs, rows):
    docs = make_docs(rows)
    got = language_id.predict(docs, language_id.fit(docs)).collect()
    assert [tuple(r)[1:] for r in got] == [("und", 0.0)] * len(rows)


def test_signs_that_are_no_letters(make_docs):
    docs = make_docs([(i, "the cat and the dog", "en", "s") for i in range(9)])
    asked = make_docs([(1, "½ ² Ⅷ", None, "s"), (2, "½ a", None, "s")])
    got = language_id.predict(asked, language_id.fit(docs)).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "und", 2: "en"}


def test_held_out_accuracy(prepared, sf_dir):
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = op2_language_id(prepared, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 20
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.93
