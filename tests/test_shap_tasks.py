"""Shapley rows and the store's rows: spread over tasks, scored once a step, summed where they are."""

import math

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tabprism.operators import attribution as A
from tabprism.plans import model_store
from tabprism.plans.model_store import spread, store
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    st = store(spark, SF_SMALL)
    return st, {"a": RandomForestRegressor(numTrees=3, maxDepth=4, seed=1).fit(st.split("train"))}


def test_rows_read_in_few_tasks_are_spread_and_small_tables_stay(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000, numPartitions=1)
    assert spread(rows) is rows
    monkeypatch.setattr(model_store, "STORED_ROWS", 10)
    out = spread(rows)
    assert out.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    many = spark.range(1000, numPartitions=cores + 1)
    assert spread(many) is many


def test_shapley_rows_are_dealt_to_tasks_and_summed_there(spark, fitted, monkeypatch):
    st, models = fitted
    feats, seen, real = st.feature_space().features, [], A.score

    def watched(rows, *args):
        seen.append(rows)
        return real(rows, *args)

    back = A.background_rows(st.raw.where("split = 'train'"), feats, 2).localCheckpoint()
    obs = st.raw.where("split = 'test'").orderBy("listing_id").limit(30).localCheckpoint()
    monkeypatch.setattr(A, "score", watched)
    monkeypatch.setattr(A, "SHAP_TASK_ROWS", 10)
    out = A.shap_weights(models, obs, back, 2, st.pre, 2)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # the deal alone
    assert seen[0].rdd.getNumPartitions() == 3
    low = {r["b"]: r for r in back.collect()}
    steps = sum(2 * (1 + sum(o[c] != low[b][c] for c in feats)) for o in obs.collect() for b in low)
    assert seen[0].count() == steps < 30 * 2 * 2 * (len(feats) + 1)
    rows = out.collect()
    assert len(rows) == 30 * len(feats)
    want = {r["listing_id"]: r["p_a"] for r in real(obs, st.pre, models, ["listing_id"]).collect()}
    base = sum(r["p_a"] for r in real(back, st.pre, models, ["b"]).collect()) / 2
    for o, p in want.items():
        assert math.isclose(sum(r["weight"] for r in rows if r["obs_id"] == o), p - base, abs_tol=1e-9)


def test_a_row_equal_to_its_background_has_no_steps_and_only_zeros(spark, fitted):
    st, models = fitted
    feats = st.feature_space().features
    back = A.background_rows(st.raw.where("split = 'train'"), feats, 1).localCheckpoint()
    twin = back.select(F.lit(7).cast("long").alias("listing_id"), *feats)
    rows = A.shap_weights(models, twin, back, 1, st.pre, 3).collect()
    assert sorted(r["feature"] for r in rows) == sorted(feats)
    assert all(r["weight"] == 0 and r["std_error"] == 0 for r in rows)
    empty = A.shap_weights(models, twin.where("listing_id < 0"), back, 1, st.pre, 3)
    assert empty.count() == 0
