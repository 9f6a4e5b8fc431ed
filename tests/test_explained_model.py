"""Explanations over raw columns: drawn rows, ridge from sums, Shapley sums, tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprism.operators import attribution as A
from tabprism.operators import models as M
from tabprism.plans.model_plans import query_grid
from tabprism.plans.model_store import EXPLAINED, store
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    """The store with ridge and forest C1 whole (boosted fits have their own, slower test)."""
    st = store(spark, SF_SMALL)
    own = [c for c in M.model_grid() if EXPLAINED[c.family] == c.no and c.family in ("LinearRegression", "RandomForest")]
    models = st.fitted(own)
    return st, {c.family: models[M.applied(c)] for c in own}


def test_explained_forest_is_whole_c1(fitted):
    forest = fitted[1]["RandomForest"]
    assert forest.getNumTrees == 100 and forest.getOrDefault("maxDepth") == 10


def test_drawn_rows_follow_the_train_rows(spark, fitted):
    st, _ = fitted
    space = st.feature_space()
    obs = st.raw.where("split = 'test'").orderBy("listing_id").limit(1)
    rows = A.perturbed(obs, space, [(1000, 0.75, "gaussian"), (1000, 0.75, "lhs")], "listing_id").toPandas()
    assert len(rows) == 2000 and len(rows["z"][0]) == 17
    own = obs.first().asDict()
    for _, part in rows.groupby("setting"):
        assert (part["z"].map(sum) == 17).any()  # the observation itself
        for c in space.pre.numeric:
            assert abs(part[c].mean() - space.pre.means[c]) < 0.2 * space.pre.stds[c]
        for j, c in enumerate(space.features):
            if c in space.frequencies:
                names, shares = space.frequencies[c]
                first = (part[c] == names[0]).mean()
                assert abs(first - shares[0]) < 0.06 and set(part[c]) <= set(names)
                assert ((part[c] == (own[c] or space.pre.modes[c])) == (part["z"].map(lambda z: z[j]) == 1)).all()
    lhs = rows[rows["setting"] == 1].iloc[1:]
    counts = np.histogram(lhs[space.pre.numeric[0]], bins=[space.pre.means[space.pre.numeric[0]] + x * space.pre.stds[space.pre.numeric[0]] for x in (-9, -0.6744898, 0, 0.6744898, 9)])[0]
    assert abs(counts - 250).max() <= 3  # strata, not luck


def test_ridge_from_sums_is_the_closed_form(spark):
    rng = np.random.default_rng(2)
    z, y, w = (rng.random((300, 5)) < 0.4).astype(float), rng.normal(size=300), rng.random(300)
    sums = {"w": w.sum(), "y_a": (w * y).sum()}
    for i in range(5):
        sums[f"z_{i}"] = (w * z[:, i]).sum()
        sums[f"z_{i}_y_a"] = (w * z[:, i] * y).sum()
        for j in range(i, 5):
            sums[f"z_{i}_{j}"] = (w * z[:, i] * z[:, j]).sum()
    df = spark.createDataFrame([{k: float(v) for k, v in sums.items()} | {"key": 1}])
    got = {r.feature: r.weight for r in A.ridge_from_sums(df, ["key"], list("abcde"), ["a"], 1.0).collect()}
    zc, yc = z - (w @ z) / w.sum(), y - (w @ y) / w.sum()
    want = np.linalg.solve(zc.T @ (w[:, None] * zc) + np.eye(5), zc.T @ (w * yc))
    assert np.allclose([got[f] for f in "abcde"], want, atol=1e-10)


def test_lime_equals_a_ridge_on_its_rows_and_needs_no_python(spark, fitted):
    st, models = fitted
    space, obs = st.feature_space(), st.raw.where("split = 'test'").orderBy("listing_id").limit(3)
    out = A.lime_weights(models, obs, space, [(200, 2.0, "gaussian"), (300, 2.0, "lhs")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Window" not in plan
    rows = {(r.model, r.obs_id, r.n_samples, r.feature): r.weight for r in out.collect()}
    assert len(rows) == 2 * 3 * 2 * 17
    drawn = A.score(A.perturbed(obs, space, [(200, 2.0, "gaussian")], "listing_id"), st.pre, models, ["obs_id", "z"]).toPandas()
    one = drawn[drawn["obs_id"] == drawn["obs_id"].iloc[0]]
    z, y = np.vstack(one["z"].to_numpy()), one["p_RandomForest"].to_numpy()
    w = np.sqrt(np.exp(-(1 - z).sum(axis=1) / 4))
    zc, yc = z - (w @ z) / w.sum(), y - (w @ y) / w.sum()
    want = np.linalg.solve(zc.T @ (w[:, None] * zc) + np.eye(17), zc.T @ (w * yc))
    got = [rows["RandomForest", int(one["obs_id"].iloc[0]), 200, f] for f in space.features]
    assert np.allclose(got, want, atol=1e-8)


def test_shapley_values_are_exact_on_a_linear_model_and_additive(spark, fitted):
    st, models = fitted
    feats = st.feature_space().features
    back = A.background_rows(st.raw.where("split = 'train'"), feats, 3)
    obs = st.raw.where("split = 'test'").orderBy("listing_id").limit(4)
    rows = A.shap_weights(models, obs, back, 3, st.pre, 6).toPandas()
    assert len(rows) == 2 * 4 * 17 and (rows["std_error"] >= 0).all()
    means = A.score(back, st.pre, models, ["b"]).toPandas()
    scored = A.score(obs, st.pre, models, ["listing_id"]).toPandas().set_index("listing_id")
    for (m, o), part in rows.groupby(["model", "obs_id"]):
        assert abs(part["weight"].sum() - (scored.loc[o, f"p_{m}"] - means[f"p_{m}"].mean())) < 1e-9
    ridge, pre = models["LinearRegression"], st.pre
    coefs = ridge.coefficients.toArray()[:len(pre.numeric)]
    low, own = back.toPandas(), obs.toPandas().set_index("listing_id")
    for r in rows[(rows["model"] == "LinearRegression") & rows["feature"].isin(pre.numeric)].itertuples():
        j = pre.numeric.index(r.feature)
        x = own.loc[r.obs_id, r.feature]
        x = pre.medians[r.feature] if x is None or np.isnan(x) else x
        want = coefs[j] * (x - low[r.feature].astype(float).fillna(pre.medians[r.feature]).mean()) / pre.stds[r.feature]
        assert abs(r.weight - want) < 1e-9


def test_tables_of_packed_explanations(spark):
    rows = [("m", 1, s, f, w) for s, ws in (("a", {"x": 3.0, "y": -2.0, "z": 1.0}), ("b", {"x": 0.5, "u": -9.0, "z": 1.0})) for f, w in ws.items()]
    e = A.packed(spark.createDataFrame(rows, "model string, obs_id long, setting string, feature string, weight double"), ["model", "obs_id", "setting"])
    top = {(r.setting, r.rnk): r.feature for r in A.top_of(e, ["setting"], 2).collect()}
    assert top == {("a", 1): "x", ("a", 2): "y", ("b", 1): "u", ("b", 2): "z"}
    table = sorted((r.rnk, r.feature, r.weight_1, r.weight_2) for r in A.sensitivity_table(e, ["model", "obs_id"], "setting", ["a", "b"], 2).collect())
    assert table == [(1, "x", 3.0, 0.0), (2, "y", -2.0, 0.0)]
    pair = e.groupBy("model").agg(F.first(F.when(F.col("setting") == "a", F.col("weights")), True).alias("l"), F.first(F.when(F.col("setting") == "b", F.col("weights")), True).alias("r"))
    assert pair.select(A.overlap_of(F.col("l"), F.col("r"), 3).alias("o")).first().o == 0.5


def test_forest_stretches_and_boosted_prefixes(spark, fitted):
    st, _ = fitted
    train, val = st.split("train"), st.split("val")
    base = {"max_depth": 4, "min_samples_leaf": 5, "max_features": "all"}
    fits = M.curve_fits("RandomForest", "n_estimators", [2, 5, 6], base)
    assert [c.params["n_estimators"] for c, _ in fits] == [2, 3, 1] and len({s for _, s in fits}) == 3
    models = st.fitted([c for c, _ in fits], [s for _, s in fits])
    own = [models[M.applied(c, s)] for c, s in fits]
    curve = {r.param_value: r for r in M.parameter_curve(train, val, "RandomForest", "n_estimators", [2, 5, 6], base, own).collect()}
    rows = val.collect()
    y = np.array([r.label for r in rows])
    p = [np.array([m.predict(r.features) for r in rows]) for m in own]
    assert abs(curve[5.0].val_rmse - np.sqrt(np.mean((y - (2 * p[0] + 3 * p[1]) / 5) ** 2))) < 1e-9
    base = {"depth": 2, "learning_rate": 0.3, "border_count": 32}
    (cfg, seed), = M.curve_fits("CatBoost", "iterations", [1, 3], base)
    boosted = st.fitted([cfg], [seed])[M.applied(cfg, seed)]
    curve = {r.param_value: r for r in M.parameter_curve(train, val, "CatBoost", "iterations", [1, 3], base, [boosted]).collect()}
    p = [np.array([t.predict(r.features) for r in rows]) for t in boosted.trees]
    assert abs(curve[3.0].val_rmse - np.sqrt(np.mean((y - p[0] - 0.3 * p[1] - 0.3 * p[2]) ** 2))) < 1e-9
    assert abs(curve[1.0].val_rmse - np.sqrt(np.mean((y - p[0]) ** 2))) < 1e-9


def test_curves_are_the_full_ones():
    assert [len(c[2]) for c in M.CURVES] == [5, 5, 6, 5]
    assert M.curves_at() == M.CURVES and M.curves_at(0.1)[3][2] == [5, 10, 15, 20, 30]
    assert len(M.model_grid()) == len(query_grid()) == 24 and query_grid(1.0) == M.model_grid()
    assert sum("reduced" in c.label for c in query_grid()) == 15
