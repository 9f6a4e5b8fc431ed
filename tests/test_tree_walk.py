"""Shapley values from one walk of the trees equal those from scoring every step."""

import math

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tabprism.operators import attribution as A
from tabprism.operators import tree_walk as W
from tabprism.operators.features import fit_preprocessor

NUM, CAT = ["n1", "n2", "n3"], ["c1", "c2"]


@pytest.fixture(scope="module")
def fitted(spark):
    """Own rows: ties, nulls, a column of two categories, and one category that train does not have."""
    rng = np.random.default_rng(3)
    rows = [(i, *[None if rng.random() < 0.1 else float(rng.integers(0, 9)) for _ in NUM], None if i % 13 == 0 else "pqrst"[rng.integers(0, 5)],
             "xy"[rng.integers(0, 2)] if i < 300 or i % 7 else "new", float(rng.normal())) for i in range(360)]
    rows = [(*r[:6], r[6] + (r[1] or 0) * (1 if r[4] == "p" else -1) + 3 * (r[5] == "x")) for r in rows]
    df = spark.createDataFrame(rows, "k long, n1 double, n2 double, n3 double, c1 string, c2 string, label double").checkpoint()
    train, obs = df.where("k < 300"), df.where("k >= 300").select("k", *NUM, *CAT)
    pre = fit_preprocessor(train, NUM, CAT)
    ready = pre.transform(train).select("features", "label").checkpoint()
    models = {"line": LinearRegression(regParam=0.1).fit(ready), "forest": RandomForestRegressor(numTrees=5, maxDepth=6, seed=1).fit(ready),
              "boosted": GBTRegressor(maxIter=6, maxDepth=4, stepSize=0.3, seed=2).fit(ready)}
    back = A.background_rows(train, NUM + CAT, 2, "k").checkpoint()
    return pre, models, obs, back


def both(monkeypatch, pre, models, obs, back, n_background, pairs):
    out = []
    for least in (10**9, 0):
        monkeypatch.setattr(A, "WALKED_FROM", least)
        df = A.shap_weights(models, obs, back, n_background, pre, pairs, "k")
        assert ("MapInArrow" in df._jdf.queryExecution().executedPlan().toString()) == (least == 0)
        out.append(sorted(map(tuple, df.collect()), key=lambda r: (r[0], -1 if r[1] is None else r[1], r[2])))
    return out


def close(want, got):
    assert [r[:3] for r in want] == [r[:3] for r in got]
    for x, y in zip(want, got):
        for a, b in zip(x[3:], y[3:]):
            assert (a is None and b is None) or math.isclose(a, b, abs_tol=1e-9), (x, y)


def test_walk_equals_scored_steps(monkeypatch, fitted):
    pre, models, obs, back = fitted
    want, got = both(monkeypatch, pre, models, obs, back, 2, 3)
    assert len(want) == 60 * 3 * 5 and sum(abs(r[3]) > 1e-6 for r in want) > 300
    close(want, got)


def test_blocks_chunks_single_pairs_and_missing_background(monkeypatch, fitted):
    pre, models, obs, back = fitted
    monkeypatch.setattr(W, "BLOCK_ROWS", 7)
    monkeypatch.setattr(W, "ENTRIES", 3)
    close(*both(monkeypatch, pre, models, obs, back, 2, 1))  # no spread of one pair: null
    want, got = both(monkeypatch, pre, models, obs, back, 3, 4)  # the third background row is not there
    assert len(got) == 60 * 3 * 5
    close(want, got)


def test_repeated_and_null_keys_are_summed_as_before(monkeypatch, fitted):
    pre, models, obs, back = fitted
    odd = obs.withColumn("k", F.when(F.col("k") % 5 == 0, None).otherwise(F.floor(F.col("k") / 2))).unionByName(obs.where("k < 310"))
    want, got = both(monkeypatch, pre, models, odd, back, 2, 2)
    assert any(r[1] is None for r in got)
    close(want, got)


def test_nodes_of_saved_trees_predict_as_the_model_does(spark, fitted):
    trees = W.trees_of(spark, fitted[1]["forest"])
    leaf = trees.left < 0
    assert (trees.slot[leaf] == -1).all() and (trees.slot[~leaf] >= 0).all() and len(trees.roots) == 5
    rows = fitted[0].transform(fitted[2]).select("features").collect()
    for r in rows[:20]:
        total = 0.0
        for node in trees.roots:
            while trees.left[node] >= 0:
                node = trees.left[node] if r.features[int(trees.slot[node])] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert math.isclose(total, fitted[1]["forest"].predict(r.features), abs_tol=1e-9)
