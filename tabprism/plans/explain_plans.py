"""Explanation queries (2J) and the contribution ops built on them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.functions.scalar import CATEGORICAL_FEATURES, NUMERICAL_FEATURES, round_doubles
from tabprism.operators import attribution as A
from tabprism.operators import explain as X
from tabprism.operators import models as M
from tabprism.operators.quantiles import exact_quantiles
from tabprism.operators.ranking import align_full, jaccard, minmax_scale, top_abs
from tabprism.plans.model_plans import observations, parameter_curves
from tabprism.plans.model_store import EXPLAINED, store
from tabprism.plans.prep_plans import _SPLIT_CTE, split_frame
from tabprism.plans.registry import query
from tabprism.session import cut_lineage, scratch_path
from tabprism.sources.listings import oracle_with

NUM = NUMERICAL_FEATURES
# Our reference linear model for exact attributions (coefficients per feature).
LINEAR_MODEL = [("accommodates", 0.06), ("bathrooms", 0.02), ("bedrooms", 0.10), ("beds", -0.01),
                ("number_of_reviews", 0.0005), ("review_scores_rating", 0.004), ("latitude", 0.01),
                ("longitude", -0.005)]


def contributions(spark: SparkSession, sf: str, reused: bool = False) -> DataFrame:
    """(method, listing_id, feature, value, weight) for every test row and feature; ``reused``: the
    query reads it more than once, so it is materialised.

    'shap' = coef * (x - train mean) (exact SHAP of a linear model);
    'lime' = coef * (x - train median) (the same model against a median baseline).
    """
    sp = split_frame(spark, sf)
    train = sp.where(F.col("split") == "train")
    test = sp.where(F.col("split") == "test")
    tl = train.unpivot([], NUM, "feature", "value").where(F.col("value").isNotNull())
    stats = tl.groupBy("feature").agg(F.avg("value").alias("mean")).join(
        exact_quantiles(tl, "value", [0.5], ["feature"], ["median"]).drop("n"), "feature")
    coefs = spark.createDataFrame(LINEAR_MODEL, "feature string, coef double")
    lng = test.unpivot(["listing_id"], NUM, "feature", "value")  # NULLs kept: they take the baseline
    shap = X.linear_contributions(lng, coefs, stats.select("feature", F.col("mean").alias("base")))
    lime = X.linear_contributions(lng, coefs, stats.select("feature", F.col("median").alias("base")))
    out = (shap.select(F.lit("shap").alias("method"), "*")
           .unionByName(lime.select(F.lit("lime").alias("method"), "*")))
    return cut_lineage(out) if reused else out


_COEF_CTE = "coef(feature, coef) AS (VALUES " + ", ".join(
    f"('{f}', CAST({c!r} AS DOUBLE))" for f, c in LINEAR_MODEL) + ")"


def _long(src: str, ids: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT {ids}'{c}' AS feature, {c} AS value FROM {src}" for c in NUM)


WC = oracle_with(_COEF_CTE) + _SPLIT_CTE + f"""
, te AS (SELECT * FROM sp WHERE split = 'test'),
  tl AS ({_long('tr', '')}),
  bm AS (SELECT feature, avg(value) AS mean, quantile_cont(value, 0.5) AS med FROM tl WHERE value IS NOT NULL
         GROUP BY feature),
  lg AS ({_long('te', 'listing_id, ')}),
  ct AS (SELECT 'shap' AS method, lg.listing_id, lg.feature, coalesce(lg.value, bm.mean) AS value,
                coef.coef * (coalesce(lg.value, bm.mean) - bm.mean) + 0.0 AS weight
         FROM lg JOIN bm ON bm.feature = lg.feature JOIN coef ON coef.feature = lg.feature
         UNION ALL
         SELECT 'lime', lg.listing_id, lg.feature, coalesce(lg.value, bm.med),
                coef.coef * (coalesce(lg.value, bm.med) - bm.med) + 0.0
         FROM lg JOIN bm ON bm.feature = lg.feature JOIN coef ON coef.feature = lg.feature),
  gi AS (SELECT feature, avg(abs(weight)) AS mean_abs FROM ct WHERE method = 'shap' GROUP BY feature),
  g5 AS (SELECT feature, mean_abs, row_number() OVER (ORDER BY mean_abs DESC, feature) AS rnk FROM gi
         ORDER BY mean_abs DESC, feature LIMIT 5),
  tk AS (SELECT *, row_number() OVER (PARTITION BY method, listing_id ORDER BY abs(weight) DESC, feature) AS rnk
         FROM ct)
"""


@query("shap_linear", "J5", oracle=WC + """SELECT listing_id, feature, round(value, 6) AS value,
  round(weight, 6) AS weight FROM ct WHERE method = 'shap'""")
def q_shap_linear(spark, sf):
    c = contributions(spark, sf).where(F.col("method") == "shap")
    return round_doubles(c.select("listing_id", "feature", "value", "weight"))


@query("shap_global", "J7", oracle=WC + """SELECT feature, round(mean_abs, 6) AS mean_abs,
  CAST(rnk AS INTEGER) AS rnk FROM g5""")
def q_shap_global(spark, sf):
    c = contributions(spark, sf).where(F.col("method") == "shap")
    return round_doubles(X.global_importance(c, 5))


@query("shap_beeswarm", "J8", oracle=WC + """
, sh AS (SELECT ct.* FROM ct JOIN g5 ON g5.feature = ct.feature WHERE method = 'shap'),
  mm AS (SELECT feature, min(value) AS mn, max(value) AS mx FROM sh GROUP BY feature)
SELECT sh.listing_id, sh.feature, round(sh.weight, 6) AS weight,
  round((sh.value - mm.mn) / (mm.mx - mm.mn + 1e-9), 6) AS scaled FROM sh JOIN mm ON mm.feature = sh.feature""")
def q_shap_beeswarm(spark, sf):
    c = contributions(spark, sf, True).where(F.col("method") == "shap")
    top = X.global_importance(c, 5).select("feature")  # 5 rows
    sh = c.join(F.broadcast(top), "feature")
    return round_doubles(minmax_scale(sh, "feature", "value").select("listing_id", "feature", "weight", "scaled"))


@query("shap_dependence", "J9", oracle=WC + """SELECT ct.listing_id, ct.feature, round(ct.value, 6) AS value,
  round(ct.weight, 6) AS weight FROM ct JOIN g5 ON g5.feature = ct.feature WHERE method = 'shap' AND g5.rnk = 1""")
def q_shap_dependence(spark, sf):
    c = contributions(spark, sf, True).where(F.col("method") == "shap")
    top1 = X.global_importance(c, 1).select("feature")
    return round_doubles(c.join(F.broadcast(top1), "feature").select("listing_id", "feature", "value", "weight"))


@query("top_contributions", "E5", oracle=WC + """SELECT method, listing_id, feature, round(weight, 6) AS weight,
  CAST(rnk AS INTEGER) AS rnk FROM tk WHERE rnk <= 5""")
def q_top_contributions(spark, sf):
    c = contributions(spark, sf)
    # window per (method, row): 8 features each
    return round_doubles(top_abs(c, ["method", "listing_id"], "weight", 5).select(
        "method", "listing_id", "feature", "weight", "rnk"))


@query("contribution_align", "F4", oracle=WC + """
, l AS (SELECT listing_id, feature, weight FROM tk WHERE method = 'lime' AND rnk <= 5),
  s AS (SELECT listing_id, feature, weight FROM tk WHERE method = 'shap' AND rnk <= 5)
SELECT coalesce(l.listing_id, s.listing_id) AS listing_id, coalesce(l.feature, s.feature) AS feature,
  round(coalesce(l.weight, 0.0), 6) AS lime_weight, round(coalesce(s.weight, 0.0), 6) AS shap_weight
FROM l FULL JOIN s ON l.listing_id = s.listing_id AND l.feature = s.feature""")
def q_contribution_align(spark, sf):
    t = top_abs(contributions(spark, sf, True), ["method", "listing_id"], "weight", 5)
    lime = t.where(F.col("method") == "lime")
    shap = t.where(F.col("method") == "shap")
    return round_doubles(align_full(lime, shap, ["listing_id", "feature"], "weight", "lime_weight", "shap_weight"))


@query("jaccard_overlap", "F5", oracle=WC + """
, l AS (SELECT listing_id, list(feature) AS fs FROM tk WHERE method = 'lime' AND rnk <= 5 GROUP BY listing_id),
  s AS (SELECT listing_id, list(feature) AS fs FROM tk WHERE method = 'shap' AND rnk <= 5 GROUP BY listing_id)
SELECT l.listing_id, round(len(list_intersect(l.fs, s.fs)) / len(list_distinct(list_concat(l.fs, s.fs))), 4)
  AS jaccard FROM l JOIN s ON s.listing_id = l.listing_id""")
def q_jaccard(spark, sf):
    t = top_abs(contributions(spark, sf), ["method", "listing_id"], "weight", 5)
    sets = t.groupBy("listing_id").agg(  # at most 10 rows per listing
        F.collect_set(F.when(F.col("method") == "lime", F.col("feature"))).alias("l"),
        F.collect_set(F.when(F.col("method") == "shap", F.col("feature"))).alias("s"))
    return sets.select("listing_id", jaccard(F.col("l"), F.col("s")).alias("jaccard"))


# F4 by setting: the same linear model against three baselines.
_BASELINES = [0.25, 0.5, 0.75]


@query("sensitivity_table", "F4", oracle=WC + """
, bq AS (SELECT feature, unnest([0.25, 0.5, 0.75]) AS q, unnest([quantile_cont(value, 0.25), quantile_cont(value, 0.5), quantile_cont(value, 0.75)]) AS base
         FROM tl WHERE value IS NOT NULL GROUP BY feature),
  cw AS (SELECT lg.listing_id, bq.q, lg.feature, coef.coef * (coalesce(lg.value, bq.base) - bq.base) + 0.0 AS weight
         FROM lg JOIN bq ON bq.feature = lg.feature JOIN coef ON coef.feature = lg.feature),
  rk AS (SELECT *, row_number() OVER (PARTITION BY listing_id, q ORDER BY abs(weight) DESC, feature) AS r FROM cw),
  t5 AS (SELECT * FROM rk WHERE r <= 5),
  fs AS (SELECT listing_id, feature, min(q * 100 + r) AS met FROM t5 GROUP BY listing_id, feature),
  fo AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY met) AS rnk FROM fs)
SELECT fo.listing_id, CAST(fo.rnk AS INTEGER) AS rnk, fo.feature,
  round(coalesce((SELECT weight FROM t5 WHERE t5.listing_id = fo.listing_id AND t5.feature = fo.feature AND q = 0.25), 0.0), 12) AS weight_1,
  round(coalesce((SELECT weight FROM t5 WHERE t5.listing_id = fo.listing_id AND t5.feature = fo.feature AND q = 0.5), 0.0), 12) AS weight_2,
  round(coalesce((SELECT weight FROM t5 WHERE t5.listing_id = fo.listing_id AND t5.feature = fo.feature AND q = 0.75), 0.0), 12) AS weight_3
FROM fo WHERE rnk <= 5""")
def q_sensitivity_table(spark, sf):
    """For each test row, the first five features met in the top-5 lists of three baselines."""
    sp = split_frame(spark, sf)
    tl = sp.where(F.col("split") == "train").unpivot([], NUM, "feature", "value").where(F.col("value").isNotNull())
    base = exact_quantiles(tl, "value", _BASELINES, ["feature"], ["b1", "b2", "b3"])
    coefs = spark.createDataFrame(LINEAR_MODEL, "feature string, coef double")
    lng = sp.where(F.col("split") == "test").unpivot(["listing_id"], NUM, "feature", "value")
    rows = lng.join(F.broadcast(base.join(coefs, "feature")), "feature")  # one row a feature
    each = F.array(*[F.struct(F.lit(q).alias("q"), (F.col("coef") * (F.coalesce("value", b) - F.col(b)) + 0.0).alias("weight")) for q, b in zip(_BASELINES, ("b1", "b2", "b3"))])
    weights = rows.select("listing_id", "feature", F.inline(each))
    return round_doubles(A.sensitivity_table(A.packed(weights, ["listing_id", "q"]), ["listing_id"], "q", _BASELINES), 12)


# ------------------------------------------------------------------ fitted models explained
# The reference's explanation settings.
DEFAULT_N, DEFAULT_KERNEL, DEFAULT_SAMPLING = 1000, 0.75, "gaussian"
N_VALUES = [100, 500, 1000]
KERNEL_WIDTHS = [0.25, 0.75, 2.0]
SAMPLING_METHODS = ["gaussian", "lhs"]
TOP_SIZES = [5, 10, 12]
DEFAULT = (DEFAULT_N, DEFAULT_KERNEL, DEFAULT_SAMPLING)

SHAP_BACKGROUND, SHAP_PAIRS = 5, 5
COMPARED_ROWS = 10  # test rows whose LIME and Shapley lists are compared


def lime(spark: SparkSession, sf: str, settings, n_rows: int = 1) -> DataFrame:
    """LIME weights of all models over all features for the first ``n_rows`` test rows. The rows are drawn
    while the models are fitted."""
    st = store(spark, sf)
    obs = observations(st.raw, n_rows)
    with ThreadPoolExecutor(1) as pool:
        drawn = pool.submit(inheritable_thread_target(spark)(lambda: A.lime_rows(obs, st.feature_space(), settings)))
        models = st.explained_models()
    return A.lime_weights(models, obs, st.feature_space(), settings, rows=drawn.result())


def shap(spark: SparkSession, sf: str) -> DataFrame:
    """(model, obs_id, feature, weight, std_error) of all models for all test rows; made once a session."""
    st = store(spark, sf)
    if "shap" not in st.made:
        space = st.feature_space()
        back = A.background_rows(st.raw.where(F.col("split") == "train"), space.features, SHAP_BACKGROUND)
        st.made["shap"] = cut_lineage(A.shap_weights(st.explained_models(), st.raw.where(F.col("split") == "test"), back, SHAP_BACKGROUND, st.pre, SHAP_PAIRS))
    return st.made["shap"]


def explanations(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (method, model, obs_id): its sorted weights. Written once a session; what ranks or
    compares explanations reads it without a shuffle."""
    st = store(spark, sf)
    if "explanations" not in st.made:
        both = (lime(spark, sf, [DEFAULT], COMPARED_ROWS).select(F.lit("lime").alias("method"), "model", "obs_id", "feature", "weight")
                .unionByName(shap(spark, sf).select(F.lit("shap").alias("method"), "model", "obs_id", "feature", "weight")))
        st.made["explanations"] = cut_lineage(A.packed(both, ["method", "model", "obs_id"]))
    return st.made["explanations"]


@query("lime_local", "J1")
def q_lime(spark, sf):
    return round_doubles(lime(spark, sf, [DEFAULT]))


@query("lime_n_sensitivity", "J2")
def q_lime_n(spark, sf):
    return round_doubles(lime(spark, sf, [(n, DEFAULT_KERNEL, DEFAULT_SAMPLING) for n in N_VALUES]))


@query("lime_kernel_sensitivity", "J3")
def q_lime_kernel(spark, sf):
    return round_doubles(lime(spark, sf, [(DEFAULT_N, k, DEFAULT_SAMPLING) for k in KERNEL_WIDTHS]))


@query("lime_sampling", "J4")
def q_lime_sampling(spark, sf):
    return round_doubles(lime(spark, sf, [(DEFAULT_N, DEFAULT_KERNEL, s) for s in SAMPLING_METHODS]))


def _lime_table(spark, sf, settings, by, values):
    weights = A.packed(lime(spark, sf, settings), ["model", "obs_id", by])
    return round_doubles(A.sensitivity_table(weights, ["model", "obs_id"], by, values))


@query("lime_n_table", "F4")
def q_lime_n_table(spark, sf):
    return _lime_table(spark, sf, [(n, DEFAULT_KERNEL, DEFAULT_SAMPLING) for n in N_VALUES], "n_samples", N_VALUES)


@query("lime_kernel_table", "F4")
def q_lime_kernel_table(spark, sf):
    return _lime_table(spark, sf, [(DEFAULT_N, k, DEFAULT_SAMPLING) for k in KERNEL_WIDTHS], "kernel_width", KERNEL_WIDTHS)


@query("lime_sampling_table", "F4")
def q_lime_sampling_table(spark, sf):
    return _lime_table(spark, sf, [(DEFAULT_N, DEFAULT_KERNEL, s) for s in SAMPLING_METHODS], "sampling", SAMPLING_METHODS)


@query("shap_sampled", "J6")
def q_shap_sampled(spark, sf):
    return round_doubles(shap(spark, sf))


@query("shap_additivity", "J6", oracle=WC + """SELECT m.model, te.listing_id AS obs_id, CAST(17 AS BIGINT) AS n_features, CAST(0 AS DOUBLE) AS gap
FROM te CROSS JOIN (SELECT unnest(['LinearRegression', 'RandomForest', 'XGBoost', 'CatBoost']) AS model) m WHERE te.log_price IS NOT NULL""")
def q_shap_additivity(spark, sf):
    """Sum of an explanation's weights less (prediction - mean prediction of the background): 0."""
    st, names = store(spark, sf), list(store(spark, sf).explained_models())
    back = A.background_rows(st.raw.where(F.col("split") == "train"), st.feature_space().features, SHAP_BACKGROUND)
    means = A.score(back, st.pre, st.explained_models(), ["b"]).agg(*[F.avg(f"p_{m}").alias(m) for m in names]).first()
    scored = A.score(st.raw.where(F.col("split") == "test"), st.pre, st.explained_models(), ["listing_id"])
    wanted = scored.select(F.col("listing_id").alias("obs_id"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), (F.col(f"p_{m}") - means[m]).alias("want")) for m in names])))
    sums = shap(spark, sf).groupBy("model", "obs_id").agg(F.count("*").alias("n_features"), F.sum("weight").alias("got"))
    joined = wanted.join(sums, ["model", "obs_id"], "left")
    return round_doubles(joined.select("model", "obs_id", "n_features", (F.abs(F.col("got") - F.col("want"))).alias("gap")))


@query("explained_top", "E5")
def q_explained_top(spark, sf):
    """The 5, 10 and 12 largest weights of each explanation of the fitted models."""
    e = explanations(spark, sf).withColumn("k", F.explode(F.array(*map(F.lit, TOP_SIZES))))
    rows = e.select("method", "model", "obs_id", "k", F.posexplode(F.slice("weights", F.lit(1), F.col("k"))).alias("r", "x"))
    return round_doubles(rows.select("method", "model", "obs_id", "k", "x.feature", "x.weight", (F.col("r") + 1).alias("rnk")))


@query("explained_overlap", "F5")
def q_explained_overlap(spark, sf):
    """Overlap of the five largest LIME and Shapley features, by model and compared row."""
    e = explanations(spark, sf)
    side = lambda m: e.where(F.col("method") == m).select("model", "obs_id", F.col("weights").alias(m))
    return side("lime").join(side("shap"), ["model", "obs_id"]).select("model", "obs_id", A.overlap_of(F.col("lime"), F.col("shap"), 5).alias("jaccard"))


def global_weights(spark, sf, k: int = 5) -> DataFrame:
    """(model, feature, mean_abs, rnk): the ``k`` features with the largest mean |weight| per model."""
    mean = shap(spark, sf).groupBy("model", "feature").agg(F.avg(F.abs("weight")).alias("mean_abs"))
    return top_abs(mean, ["model"], "mean_abs", k)  # 17 rows a model


@query("explained_global", "J7")
def q_explained_global(spark, sf):
    return round_doubles(global_weights(spark, sf))


def _valued(spark, sf, k: int) -> DataFrame:
    """Weights of each model's ``k`` global features with the rows' own values (a number or a category)."""
    st = store(spark, sf)
    raw = st.raw.where(F.col("split") == "test")
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.lit(None).cast("string").alias("category")) for c in NUM]
    pairs += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("value"), F.col(c).alias("category")) for c in CATEGORICAL_FEATURES]
    values = raw.select(F.col("listing_id").alias("obs_id"), F.inline(F.array(*pairs)))
    top = F.broadcast(global_weights(spark, sf, k).select("model", "feature", "rnk"))  # k rows a model
    return shap(spark, sf).join(top, ["model", "feature"]).join(values, ["obs_id", "feature"])


@query("explained_beeswarm", "J8")
def q_explained_beeswarm(spark, sf):
    v = minmax_scale(_valued(spark, sf, 5), "feature", "value")
    return round_doubles(v.select("model", "obs_id", "feature", "weight", "scaled", "category"))


@query("explained_dependence", "J9")
def q_explained_dependence(spark, sf):
    return round_doubles(_valued(spark, sf, 1).select("model", "obs_id", "feature", "value", "category", "weight"))


# ------------------------------------------------------------------ saved artefacts
def save_artefacts(spark: SparkSession, sf: str, folder: str, curves: DataFrame) -> DataFrame:
    """Models, learning curves and explanations with a manifest (kind, model, config, path),
    itself a table under ``folder``."""
    st, rows = store(spark, sf), []
    for c in M.model_grid():
        if EXPLAINED[c.family] == c.no:
            path = f"{folder}/model-{c.family}"
            st.explained_models()[c.family].write().overwrite().save(path)
            rows.append(("model", c.family, c.label, path))
    for kind, table in (("curve", curves), ("explanation", explanations(spark, sf))):
        table.write.parquet(f"{folder}/{kind}")
        rows.append((kind, None, None, f"{folder}/{kind}"))
    spark.createDataFrame(rows, "kind string, model string, config string, path string").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def load_models(manifest: DataFrame) -> dict[str, object]:
    """The saved models of a manifest, by family; one row each."""
    from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
    kinds = {"LinearRegression": LinearRegressionModel, "RandomForest": RandomForestRegressionModel}
    return {r["model"]: kinds.get(r["model"], GBTRegressionModel).load(r["path"]) for r in manifest.where("kind = 'model'").collect()}


@query("artefacts_roundtrip", "A7", oracle="""SELECT * FROM (VALUES ('model', 'LinearRegression', true), ('model', 'RandomForest', true), ('model', 'XGBoost', true),
  ('model', 'CatBoost', true), ('explanation', NULL, true), ('curve', NULL, true)) t(kind, model, equal)""")
def q_artefacts_roundtrip(spark, sf):
    """Everything saved, loaded again and compared by value: predictions of all test rows, and all rows of the tables."""
    st = store(spark, sf)
    curves = cut_lineage(parameter_curves(spark, sf))
    manifest = save_artefacts(spark, sf, scratch_path(spark, "artefacts"), curves)
    loaded, own = load_models(manifest), st.explained_models()
    scored = st.split("test").select("features")
    for name in own:
        for side, m in (("a", own[name]), ("b", loaded[name])):
            scored = m.copy({m.predictionCol: f"{side}_{name}"}).transform(scored)
    same = scored.agg(*[F.bool_and(F.col(f"a_{n}") == F.col(f"b_{n}")).alias(n) for n in own])
    out = same.select(F.inline(F.array(*[F.struct(F.lit("model").alias("kind"), F.lit(n).alias("model"), F.col(n).alias("equal")) for n in own])))
    digest = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    for kind, table in (("curve", curves), ("explanation", explanations(spark, sf))):
        back = spark.read.parquet(manifest.where(F.col("kind") == kind).first()["path"])
        out = out.unionByName(spark.createDataFrame([(kind, None, digest(table) == digest(back))], "kind string, model string, equal boolean"))
    return out
