"""The classifier's vectors, its optimum and its edges against small numpy versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprism.operators import models as M
from tabprism.operators import text as T

GOOD, BAD = ["bright garden view", "bright calm flat", "calm garden flat", "bright bright view calm"], ["dark noisy flat", "noisy street view", "dark dark street", "noisy dark garden"]


def _table(spark, extra=()):
    rows = [(i, t, "Positive" if t in GOOD else "Negative", "train") for i, t in enumerate((GOOD + BAD) * 3)]
    return spark.createDataFrame(rows + list(extra), "id long, words string, mood string, split string").repartition(5)


@pytest.fixture(scope="module")
def fit(spark):
    extra = [(100, None, "Positive", "test"), (101, "", "Negative", "test"), (102, "unknown things", "Negative", "test"),
             (103, "bright garden", "Positive", "test")]
    return M.fit_text_classifier(_table(spark, extra), "id", "words", "mood", positive="Positive")


def test_vectors_hold_the_weights(spark, fit):
    docs = _table(spark)
    weights, vocab = T.tfidf(docs, "id", "words")
    places = {r.term: r.idx for r in vocab.collect()}
    want = {}
    for r in weights.collect():
        want.setdefault(r.id, {})[places[r.term]] = r.weight
    got = {r.id: dict(zip(r.features.indices.tolist(), r.features.values.tolist())) for r in fit.documents.where("id < 100").collect()}
    assert {k: pytest.approx(v) for k, v in want.items()} == got
    assert all(r.features.indices.tolist() == sorted(r.features.indices.tolist()) for r in fit.documents.collect())


def test_rows_without_known_terms_are_empty_vectors(fit):
    empty = {r.id: r.features for r in fit.documents.where("id BETWEEN 100 AND 102").collect()}
    assert len(empty) == 3 and all(v.numNonzeros() == 0 and v.size == fit.vocabulary.count() for v in empty.values())
    assert fit.predictions().where("id = 103").first().prediction == "Positive"


def test_optimum_equals_newton(fit):
    rows = fit.documents.where("split = 'train'").collect()
    x = np.array([np.r_[r.features.toArray(), 1.0] for r in rows])
    y, w = np.array([r.y for r in rows]), np.array([r.w for r in rows])
    ridge = np.diag(np.r_[np.ones(x.shape[1] - 1), 0.0])
    b = np.zeros(x.shape[1])
    for _ in range(50):  # the penalised sum, C = 1
        p = 1 / (1 + np.exp(-x @ b))
        b -= np.linalg.solve((x.T * (w * p * (1 - p))) @ x + ridge, x.T @ (w * (p - y)) + ridge @ b)
    assert np.allclose(fit.model.coefficients.toArray(), b[:-1], atol=1e-4)
    assert fit.model.intercept == pytest.approx(b[-1], abs=1e-4)


def test_gradient_is_zero_only_at_the_optimum(spark, fit):
    rows = M.classifier_gradients(fit).collect()
    assert len(rows) == fit.vocabulary.count() + 1 and max(abs(r.gradient) for r in rows) < 1e-6
    early = M.fit_text_classifier(_table(spark), "id", "words", "mood", positive="Positive", max_iter=1)
    assert max(abs(r.gradient) for r in M.classifier_gradients(early).collect()) > 1e-4


def test_top_terms_are_the_extremes(fit):
    top = M.top_terms(fit, 2).collect()
    coef = sorted(fit.model.coefficients.toArray())
    assert sorted(r.coef for r in top) == pytest.approx(coef[:2] + coef[-2:])
    assert {r.term for r in top if r.side == "positive"} >= {"bright"}


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError, match="two classes"):
        M.fit_text_classifier(_table(spark).where(F.col("mood") == "Positive"), "id", "words", "mood", positive="Positive")


def test_no_python_in_the_plan(fit):
    plan = fit.predictions()._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
