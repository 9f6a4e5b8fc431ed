"""LIME's rows are drawn while the models are fitted, and the ridges of all models share one plan."""

import threading

import numpy as np
from pyspark.ml.regression import RandomForestRegressor

from tabprism.operators import attribution as A
from tabprism.plans import explain_plans as E
from tabprism.plans.model_store import Store, store
from tests.conftest import SF_SMALL


def test_rows_are_drawn_while_the_models_are_fitted(spark, monkeypatch):
    st, drawn, real = store(spark, SF_SMALL), threading.Event(), A.lime_rows
    model = RandomForestRegressor(numTrees=2, maxDepth=3, seed=1).fit(st.split("train"))

    def watched(*args):
        out = real(*args)
        drawn.set()
        return out

    monkeypatch.setattr(A, "lime_rows", watched)
    monkeypatch.setattr(Store, "explained_models", lambda self: {"a": model} if drawn.wait(300) else {})
    got = E.lime(spark, SF_SMALL, [(60, 0.75, "gaussian")]).collect()
    assert len(got) == len(st.feature_space().features) and {r["model"] for r in got} == {"a"}


def test_ridges_of_all_targets_come_from_one_plan(spark):
    rng = np.random.default_rng(3)
    z, w, ys = rng.integers(0, 2, (50, 4)).astype(float), rng.uniform(0.1, 1, 50), rng.normal(size=(2, 50))
    sums = {"key": 1, "w": w.sum()} | {f"z_{i}": (w * z[:, i]).sum() for i in range(4)}
    sums |= {f"z_{i}_{j}": (w * z[:, i] * z[:, j]).sum() for i in range(4) for j in range(i, 4)}
    for t, y in zip("ab", ys):
        sums |= {f"y_{t}": (w * y).sum()} | {f"z_{i}_y_{t}": (w * z[:, i] * y).sum() for i in range(4)}
    df = spark.createDataFrame([tuple(float(v) if k != "key" else v for k, v in sums.items())], list(sums))
    out = A.ridge_from_sums(df, ["key"], list("mnop"), ["a", "b"], 1.0)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["model"], r["feature"]): r["weight"] for r in out.collect()}
    c = z - (w[:, None] * z).sum(0) / w.sum()
    for t, y in zip("ab", ys):
        want = np.linalg.solve((w[:, None] * c).T @ c + np.eye(4), (w[:, None] * c).T @ (y - (w * y).sum() / w.sum()))
        assert np.allclose([got[t, f] for f in "mnop"], want, atol=1e-12)
