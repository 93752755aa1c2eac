"""Language identification: held-out accuracy, defined cases, kernels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from airlens.llm import language


def test_held_out_accuracy_and_ranges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.predict_table(docs).join(docs.select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.count(F.lit(1)).alias("n"),
                                  F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.n > 100 and r.a > 0.98 and 0 <= r.lo <= r.hi <= 1


def test_defined_cases(hard, nothing):
    got = {}
    for r in language.predict_table(hard).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len([x for v in got.values() for x in v]) == hard.count()
    for doc_id in (0, 1, 3):   # null, empty, blank
        assert [(r.lang_pred, r.score) for r in got[doc_id]] == [("und", 0.0)]
    assert {r.lang_pred for r in got[4]} == {"en"}
    assert len({(r.lang_pred, r.score) for r in got[7]}) == 1
    assert all(r.held_out for r in got[None])
    assert language.predict_table(nothing).count() == 0


def test_nothing_learned_is_und(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language.predict_table(docs).first()["lang_pred"] == "und"


def test_weights_are_the_kernel_machine():
    """Scoring by the folded weight matrix equals kernels with the landmarks times coefficients."""
    texts = [("a", "the cat sat on the mat"), ("a", "the dog sat on a log"), ("b", "der hund und die katze"), ("b", "die maus und der hund")]
    sample = [(l, language.present(t)) for l, t in texts]
    langs, w = language.fit(sample)
    f = language.scores([language.present("the cat and the dog"), language.present("der hund")], w)
    assert langs == ["a", "b"] and f[0].argmax() == 0 and f[1].argmax() == 1
    k = np.array([[len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y)) for _, y in sample] for _, x in sample])
    y = np.array([[1.0 if l == c else -1.0 for c in langs] for l, _ in sample])
    alpha = np.linalg.solve(k.T @ k + language.RIDGE * k + 1e-8 * np.eye(4), k.T @ y)
    q = language.present("the cat and the dog")
    kq = np.array([len(np.intersect1d(q, y)) / np.sqrt(len(q) * len(y)) for _, y in sample])
    assert f[0] == pytest.approx(kq @ alpha, abs=1e-3)


def test_tables_train_what_the_kernel_machine_is(spark, sample):
    """All texts as landmarks: predictions equal ridge regression on the full kernel matrix, by definition."""
    known = sample.where("lang is not null and text is not null").where(~language.held_out()).collect()
    texts = [(r.lang, language.present(r.text)) for r in known]
    langs, model = language.train(sample, per_language=10 ** 6, landmarks=10 ** 6)
    phi = np.zeros((len(texts), language.BINS), np.float32)
    for i, (_, b) in enumerate(texts):
        phi[i, b] = 1 / np.sqrt(len(b))
    k = phi.astype(np.float64) @ phi.T.astype(np.float64)
    y = np.array([[1.0 if l == c else -1.0 for c in langs] for l, _ in texts])
    alpha = np.linalg.solve(k.T @ k + language.RIDGE * k + 1e-8 * np.eye(len(k)), k.T @ y)
    assert len(known) <= language.MARKS and langs == sorted({l for l, _ in texts})
    for r in sample.where(language.held_out()).limit(20).collect():
        q = language.present(r.text)
        kq = phi[:, q].sum(axis=1) / np.sqrt(len(q))
        assert language.values([q], model)[0] == pytest.approx(kq @ alpha, abs=5e-3)


def test_any_number_of_languages(spark, monkeypatch):
    """More languages than landmarks, and no weight matrix: scored by kernels with the landmarks."""
    monkeypatch.setattr(language, "WEIGHT_BYTES", 0)
    docs = spark.createDataFrame([(i, f"word{i % 1300} zz{i % 1300 * 7919} common text", f"l{i % 1300:04d}") for i in range(2600)], "doc_id long, text string, lang string")
    langs, (marks, coefficients) = language.train(docs)
    assert 1024 < len(langs) <= 1300 and marks.shape == (language.MARKS, language.BINS // 64) and coefficients.shape == (language.MARKS, len(langs))
    few = docs.where("doc_id < 50")
    got = language.identify(few, (langs, (marks, coefficients))).collect()
    folded = {r.doc_id: r for r in language.identify(few, (langs, language.folded(marks, coefficients))).collect()}
    assert len(got) == 50 and all(r.lang_pred in langs and 0 <= r.score <= 1 for r in got)
    assert all(r.score == pytest.approx(folded[r.doc_id].score, abs=1e-3) for r in got)


def test_ties_go_to_the_first_name_and_equal_rows_count_once(spark):
    docs = spark.createDataFrame([(i, "same words in both", lang) for i in range(1, 40) for lang in ("b", "a")] * 3, "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.predict_table(docs).collect()} == {("a", 0.5)}
