"""Properties on the driver's sf0.001 tables."""

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tabprism.functions.binning import PRICE_BINS_8
from tabprism.functions.scalar import NUMERICAL_FEATURES, adaptive_price
from tabprism.operators import bins as B
from tabprism.operators import explain as X
from tabprism.operators import models as M
from tabprism.operators.sampling import sample_exact, split3, split_stratified
from tabprism.plans.prep_plans import prepared, split_frame
from tabprism.sources.listings import listings_clean


def test_bucket_counts_sum_to_rows(spark):
    lc = listings_clean(spark, SF_SMALL)
    b = B.bucket_counts(lc, adaptive_price(lc), PRICE_BINS_8).collect()
    assert [r["ord"] for r in sorted(b, key=lambda r: r["ord"])] == list(range(1, 9))
    assert sum(r["n"] for r in b) == lc.count()
    assert abs(sum(r["share"] for r in b) - 100.0) < 1e-9


def test_split_disjoint_complete_and_partition_independent(spark):
    lc = listings_clean(spark, SF_SMALL).select("listing_id")
    a = {r[0]: r[1] for r in split3(lc, "listing_id").select("listing_id", "split").collect()}
    b = {r[0]: r[1] for r in split3(lc.repartition(7), "listing_id").select("listing_id", "split").collect()}
    assert a == b and len(a) == lc.count()
    share = sum(1 for v in a.values() if v == "train") / len(a)
    assert 0.5 < share < 0.7


def test_stratified_split_exact_shares(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("string").alias("lab"))
    out = split_stratified(df, "k", "lab", 0.2).groupBy("lab", "split").count().collect()
    got = {(r["lab"], r["split"]): r["count"] for r in out}
    assert got[("true", "test")] == 50 and got[("false", "test")] == 150


def test_sample_exact_is_repeatable(spark):
    lc = listings_clean(spark, SF_SMALL)
    a = [r[0] for r in sample_exact(lc, "listing_id", 100).select("listing_id").collect()]
    b = [r[0] for r in sample_exact(lc.repartition(5), "listing_id", 100).select("listing_id").collect()]
    assert a == b and len(a) == 100


def test_scaled_train_mean0_std1_and_names(spark):
    prep, pre = prepared(spark, SF_SMALL)
    from pyspark.ml.functions import vector_to_array
    arr = prep.where(F.col("split") == "train").select(vector_to_array("features").alias("a")).toPandas()
    X_ = np.vstack(arr["a"].to_numpy())
    nnum = len(NUMERICAL_FEATURES)
    assert np.allclose(X_[:, :nnum].mean(0), 0, atol=1e-9)
    stds = X_[:, :nnum].std(0)
    assert np.all((np.abs(stds - 1) < 1e-9) | (stds == 0))
    assert X_.shape[1] == len(pre.feature_names())
    # one-hot blocks: exactly one slot per categorical column for train rows
    assert np.allclose(X_[:, nnum:].sum(1), len(pre.categorical))


def test_ridge_matches_normal_equations(spark):
    prep, _ = prepared(spark, SF_SMALL)
    train = prep.where(F.col("split") == "train")
    n = train.count()
    ys = M.label_std(train)
    cfg = M.model_grid()[2]  # alpha = 1
    model = M.estimator(cfg, n, ys).fit(train)
    from pyspark.ml.functions import vector_to_array
    pdf = train.select(vector_to_array("features").alias("a"), "label").toPandas()
    Xm = np.vstack(pdf["a"].to_numpy())
    y = pdf["label"].to_numpy()
    Xc, yc = Xm - Xm.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + 1.0 * np.eye(Xm.shape[1]), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), beta, atol=1e-5)


def test_tfidf_rows_have_unit_norm(spark):
    from tabprism.plans.text_plans import binary_split
    from tabprism.operators.text import tfidf
    sp = binary_split(spark, SF_SMALL)
    w, vocab = tfidf(sp, "listing_id", "name_clean")
    norms = w.groupBy("listing_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert norms and all(abs(r["n"] - 1) < 1e-9 for r in norms)


def test_metrics_rmse_at_least_mae(spark):
    from tabprism.plans.model_plans import PREDICTORS, group_mean_predictions
    p = group_mean_predictions(spark, SF_SMALL, [(m, 1, k, None) for m, k in PREDICTORS])
    for r in M.regression_metrics(p, ["model"], "y", "yhat").collect():
        assert r["rmse"] >= r["mae"] >= 0


def test_zscore_filter_counts(spark):
    sp = split_frame(spark, SF_SMALL)
    assert sp.count() <= listings_clean(spark, SF_SMALL).count()


def test_exact_quantiles_with_a_hot_key(spark):
    """One key holds a third of all rows beside many small groups: results stay exact."""
    from tabprism.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(11)
    n = 6000
    keys = ["hot" if i % 3 == 0 else f"k{i % 397}" for i in range(n)]
    vals = rng.lognormal(size=n).round(4)
    df = spark.createDataFrame([(k, float(v)) for k, v in zip(keys, vals)], "k string, v double")
    got = {r["k"]: r for r in exact_quantiles(df, "v", [0.25, 0.5, 0.99], ["k"], ["a", "b", "c"]).collect()}
    for key in ["hot", "k1", "k200"]:
        arr = np.array([v for k, v in zip(keys, vals) if k == key])
        assert got[key]["n"] == len(arr)
        assert np.allclose([got[key]["a"], got[key]["b"], got[key]["c"]], np.percentile(arr, [25, 50, 99]),
                           atol=1e-12)
    assert len(got) == len(set(keys))


def test_ridge_from_one_matrix_of_products(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6)) * (rng.random((400, 6)) < 0.5)
    y = x @ np.arange(6) + 3 + rng.normal(size=400)
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"])
    for alpha, (beta, start) in M.ridge_from_gram(df, [0.1, 10.0]).items():
        xc, yc = x - x.mean(0), y - y.mean()
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(6), xc.T @ yc)
        assert np.allclose(beta, want, atol=1e-10) and abs(start - (y.mean() - x.mean(0) @ want)) < 1e-10
