"""Models, sweeps and evaluation (section 2I) plus the text classifier.

Fits are Spark ML estimators on the prepared train split (one distributed job per
pass / tree level / boosting iteration). Metrics are one grouped aggregate over a
long (model, y, yhat) table, so any number of models is scored in a single pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprism.session import cut_lineage, scratch_path

RANDOM_STATE = 42
BOOSTED = ("XGBoost", "CatBoost")
FOREST_MEMORY_MB = 1024  # node statistics held at once; fewer passes over the rows


@dataclass(frozen=True)
class Config:
    family: str
    no: int
    label: str
    params: dict
    not_applied: tuple[str, ...] = ()


# The reference's 4 x 6 configuration grid (hyperparameters as given).
def model_grid() -> list[Config]:
    g = []
    for i, a in enumerate([0.01, 0.1, 1.0, 10.0, 50.0, 100.0], 1):
        g.append(Config("LinearRegression", i, f"C{i}: alpha={a}", {"alpha": a}))
    rf = [(100, 10, 5, "sqrt"), (200, 15, 5, "sqrt"), (200, 20, 2, "sqrt"), (200, None, 2, "sqrt"),
          (300, None, 1, "sqrt"), (300, None, 1, 0.5)]
    for i, (n, d, leaf, feat) in enumerate(rf, 1):
        g.append(Config("RandomForest", i, f"C{i}: n={n},d={d},leaf={leaf},feat={feat}",
                        {"n_estimators": n, "max_depth": d, "min_samples_leaf": leaf, "max_features": feat}))
    xgb = [("C1: n=100,d=4,lr=0.10,sub=0.8", 100, 4, 0.10, 0.8, 0.8, 0.0, 1.0),
           ("C2: n=200,d=6,lr=0.05,sub=0.8", 200, 6, 0.05, 0.8, 0.8, 0.0, 1.0),
           ("C3: n=300,d=6,lr=0.05,sub=0.9", 300, 6, 0.05, 0.9, 0.8, 0.0, 1.0),
           ("C4: n=300,d=8,lr=0.03,sub=0.9", 300, 8, 0.03, 0.9, 0.7, 0.0, 1.0),
           ("C5: n=300,d=8,lr=0.03,L1=0.1", 300, 8, 0.03, 0.9, 0.7, 0.1, 1.0),
           ("C6: n=500,d=6,lr=0.02,L1=0.1,L2=2", 500, 6, 0.02, 0.9, 0.7, 0.1, 2.0)]
    for i, (label, n, d, lr, sub, col, l1, l2) in enumerate(xgb, 1):
        g.append(Config("XGBoost", i, label,
                        {"n_estimators": n, "max_depth": d, "learning_rate": lr, "subsample": sub,
                         "colsample_bytree": col, "reg_alpha": l1, "reg_lambda": l2},
                        ("reg_alpha", "reg_lambda")))
    cb = [("C1: iter=200,d=6,lr=0.10,l2=3", 200, 6, 0.10, 3, 1.0, 128),
          ("C2: iter=300,d=6,lr=0.05,l2=3", 300, 6, 0.05, 3, 1.0, 128),
          ("C3: iter=500,d=8,lr=0.03,l2=5", 500, 8, 0.03, 5, 1.0, 128),
          ("C4: iter=500,d=8,lr=0.03,l2=10", 500, 8, 0.03, 10, 1.0, 128),
          ("C5: iter=500,d=8,lr=0.03,l2=5,bt=0.5", 500, 8, 0.03, 5, 0.5, 64),
          ("C6: iter=700,d=6,lr=0.02,l2=5,bt=0.5", 700, 6, 0.02, 5, 0.5, 64)]
    for i, (label, n, d, lr, l2, bt, bc) in enumerate(cb, 1):
        g.append(Config("CatBoost", i, label,
                        {"iterations": n, "depth": d, "learning_rate": lr, "l2_leaf_reg": l2,
                         "bagging_temperature": bt, "border_count": bc},
                        ("l2_leaf_reg", "bagging_temperature")))
    return g


def reduced(cfg: Config, share: float) -> Config:
    """The config with a share of its trees or iterations; its label says so. Depth and all other
    parameters stay."""
    p = {k: max(2, round(v * share)) if k in ("n_estimators", "iterations") else v for k, v in cfg.params.items()}
    changed = [f"{k}={p[k]}" for k in p if p[k] != cfg.params[k]]
    return Config(cfg.family, cfg.no, f"{cfg.label} [reduced: {', '.join(changed)}]" if changed else cfg.label, p, cfg.not_applied)


def label_std(train: DataFrame, label: str = "label") -> float:
    return train.select(F.stddev_pop(label)).first()[0]


def estimator(cfg: Config, n_train: int, y_std: float, features: str = "features", label: str = "label"):
    """Spark ML estimator for one reference configuration.

    Ridge: Spark divides the penalty by the label's population std, so
    ``regParam = alpha * std(y) / n`` reproduces ``||y - Xb||^2 + alpha ||b||^2``.
    Forest depth ``None`` -> 30 (Spark's maximum). Boosting knobs without a Spark
    counterpart (L1/L2 leaf penalties, bagging temperature) are recorded, not applied.
    """
    p = cfg.params
    if cfg.family == "LinearRegression":
        return LinearRegression(featuresCol=features, labelCol=label, elasticNetParam=0.0,
                                regParam=p["alpha"] * y_std / n_train, standardization=False,
                                solver="normal")
    if cfg.family == "RandomForest":
        feat = p["max_features"]
        return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=p["n_estimators"],
                                     maxDepth=30 if p["max_depth"] is None else p["max_depth"],
                                     minInstancesPerNode=p["min_samples_leaf"],
                                     featureSubsetStrategy=str(feat) if not isinstance(feat, str) else feat,
                                     maxMemoryInMB=FOREST_MEMORY_MB,
                                     seed=RANDOM_STATE)
    if cfg.family == "XGBoost":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=p["n_estimators"],
                            maxDepth=p["max_depth"], stepSize=p["learning_rate"],
                            subsamplingRate=p["subsample"], featureSubsetStrategy=str(p["colsample_bytree"]),
                            seed=RANDOM_STATE)
    if cfg.family == "CatBoost":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=p["iterations"],
                            maxDepth=p["depth"], stepSize=p["learning_rate"], maxBins=p["border_count"],
                            seed=RANDOM_STATE)
    raise ValueError(cfg.family)


def regression_metrics(pred: DataFrame, by: Sequence[str], y: str = "label", yhat: str = "prediction") -> DataFrame:
    """I8: RMSE, MAE, R2 = 1 - SSE / (n var_pop(y)) per group, one aggregate."""
    e = F.col(y) - F.col(yhat)
    return pred.groupBy(*by).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.sum(e * e) / (F.count(F.lit(1)) * F.var_pop(y))).alias("r2"))


def hyper_map(cfg: Config):
    return F.create_map(*[x for k, v in cfg.params.items() for x in (F.lit(k), F.lit(str(v)))])


# ------------------------------------------------------------------ fits side by side
BOOST_ROWS, FOREST_ROWS = 20_000, 1_000  # rows a task, where the table is small
FITS_AT_ONCE = 8


def sized(train: DataFrame, n: int, each: int) -> DataFrame:
    """``train`` in as many partitions as its rows ask for, up to the session's cores. A boosted fit is
    thousands of short jobs, each as dear as its number of tasks; a forest is few and heavy ones.
    A table with more partitions than cores is dealt evenly to whole waves of tasks: every level of
    every tree would wait for the few tasks left over from the last full wave."""
    cores, now = train.sparkSession.sparkContext.defaultParallelism, train.rdd.getNumPartitions()
    if now > cores:
        return train if now % cores == 0 else train.repartition(-(-now // cores) * cores)
    parts = min(cores, max(1, -(-n // each)))
    return train if now == parts else train.coalesce(parts) if parts < now else train.repartition(parts)


def cache_bytes(spark: SparkSession) -> int:
    """Memory that the session has for stored rows: the executors' and the driver's."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    most = []
    while status.hasNext():
        most.append(status.next()._1())
    return sum(most)


def binned_bytes(cfg: Config, n: int, slots: int) -> int:
    """What a fit keeps stored until it ends: an integer per row and slot, for forests also one per
    row and tree, and the objects around them (measured: 884 bytes a row of 179 slots)."""
    trees = cfg.params["n_estimators"] if cfg.family == "RandomForest" else 0
    return 0 if cfg.family == "LinearRegression" else n * (4 * (slots + trees) + 168)


def at_once(largest: int, cache: int) -> int:
    """How many fits run side by side: their stored rows may take half of the memory. What does not
    fit is read back from disk in every level, far dearer than a fit that waits for its turn; and
    rows that fill the memory keep all cores busy in one fit."""
    return max(1, min(FITS_AT_ONCE, cache // 2 // max(1, largest)))


def applied(cfg: Config, seed: int | None = None) -> tuple:
    """What tells fits apart: the parameters that are applied, and the seed."""
    return cfg.family, tuple((k, v) for k, v in cfg.params.items() if k not in cfg.not_applied), seed


def fit_all(train: DataFrame, configs: Sequence[Config], seeds: Sequence[int | None] | None = None) -> dict[tuple, object]:
    """Models of all configs by ``applied``, fitted side by side in driver threads (a boosted fit
    waits for its own jobs most of the time). ``train`` should be materialised: every fit reads it."""
    n, ys = train.agg(F.count(F.lit(1)), F.stddev_pop("label")).first()
    boost, forest = sized(train, n, BOOST_ROWS), cut_lineage(sized(train, n, FOREST_ROWS))
    distinct = {applied(c, s): (c, s) for c, s in zip(configs, seeds or [None] * len(configs))}

    def work(k: tuple) -> int:  # the longest first, so that none is left alone at the end
        p = dict(k[1])
        return (p.get("iterations") or p.get("n_estimators") or 0) * (p.get("depth") or p.get("max_depth") or 30)

    def fit(k: tuple):
        cfg, seed = distinct[k]
        est = estimator(cfg, n, ys)
        return (est if seed is None else est.setSeed(seed)).fit(boost if cfg.family in BOOSTED else forest)

    order = sorted(distinct, key=work, reverse=True)
    slots = max((r["features"].size for r in train.select("features").take(1)), default=0)
    largest = max((binned_bytes(cfg, n, slots) for cfg, _ in distinct.values()), default=0)
    with ThreadPoolExecutor(at_once(largest, cache_bytes(train.sparkSession))) as pool:
        return dict(zip(order, pool.map(inheritable_thread_target(train.sparkSession)(fit), order)))


def config_sweep(train: DataFrame, evaluate: DataFrame, configs: Sequence[Config], fitted: dict | None = None) -> DataFrame:
    """Fit every config on ``train``, score on ``evaluate``; one row per config.

    Predictions of all configs are columns of one pass and scored with a single grouped
    aggregate. Configs that differ only in parameters that are not applied share one fit and
    are reported each. ``fitted``: models that are there already.
    """
    fitted = fitted or fit_all(train, configs)
    scored, used = evaluate.select("features", "label"), list(dict.fromkeys(map(applied, configs)))
    for i, k in enumerate(used):
        scored = fitted[k].copy({fitted[k].predictionCol: f"p{i}"}).transform(scored)
    pairs = F.array(*[F.struct(F.lit(c.family).alias("model"), F.lit(c.no).alias("config_no"), F.col(f"p{used.index(applied(c))}").alias("prediction")) for c in configs])
    met = regression_metrics(scored.select("label", F.inline(pairs)), ["model", "config_no"])
    meta = evaluate.sparkSession.createDataFrame(
        [(c.family, c.no, c.label, {k: str(v) for k, v in c.params.items()}, list(c.not_applied)) for c in configs],
        "model string, config_no int, config_label string, hyperparameters map<string,string>, not_applied array<string>")
    return meta.join(met, ["model", "config_no"])


MAX_GRAM_SLOTS = 4_000  # the matrix of products on the driver: 128 MB


def ridge_from_gram(train: DataFrame, alphas: Sequence[float]) -> dict[float, tuple[np.ndarray, float]]:
    """(coefficients, intercept) by alpha, all from one pass: the products of each row's set slots
    are summed per pair of slots (map-side first), and the small system is solved on the driver."""
    width = train.select(F.max(F.size(vector_to_array("features")))).first()[0]
    if width > MAX_GRAM_SLOTS:
        raise ValueError(f"more than {MAX_GRAM_SLOTS} slots; use the iterative solver")
    # The label and a constant 1 join as two more slots, so one table holds all sums.
    slots = F.concat(vector_to_array("features"), F.array(F.col("label").cast("double"), F.lit(1.0)))
    rows = train.select(F.filter(F.transform(slots, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda e: e["x"] != 0).alias("e"))
    pairs = rows.select(F.inline(F.expr("flatten(transform(e, (p, k) -> transform(slice(e, k + 1, size(e)), q -> struct(p.i AS i, q.i AS j, p.x * q.x AS v))))")))
    gram = np.zeros((width + 2, width + 2))
    for i, j, v in pairs.groupBy("i", "j").agg(F.sum("v")).collect():  # (width + 2)^2 / 2 sums at most
        gram[i, j] = gram[j, i] = v
    n, mean = gram[-1, -1], gram[-1, :-1] / gram[-1, -1]
    inner = gram[:-1, :-1] - n * np.outer(mean, mean)
    out = {}
    for a in alphas:
        beta = np.linalg.solve(inner[:-1, :-1] + a * np.eye(width), inner[:-1, -1])
        out[a] = (beta, float(mean[-1] - mean[:-1] @ beta))
    return out


def ridge_gradients(train: DataFrame, models: dict[int, tuple[float, object]]) -> DataFrame:
    """(config_no, slot, gradient): mean over the rows of ``x * (y - prediction)`` less the penalty
    ``alpha * coefficient / rows``, by coefficient. One aggregate over the set slots of all rows."""
    rows = train
    for no, (_, m) in models.items():
        rows = m.copy({m.predictionCol: f"p{no}"}).transform(rows)
    residuals = F.array(*[F.col("label") - F.col(f"p{no}") for no in models])
    slots = rows.select(residuals.alias("e"), F.posexplode(vector_to_array("features")).alias("slot", "x")).where("x <> 0")
    sums = slots.groupBy("slot").agg(*[F.sum(F.col("x") * F.col("e")[i]).alias(f"g{i}") for i in range(len(models))])
    n = train.count()
    entries = F.array(*[F.struct(F.lit(no).alias("config_no"), (F.col(f"g{i}") / n - F.element_at(F.array(*[F.lit(float(b)) for b in m.coefficients]), F.col("slot") + 1) * (a / n)).alias("gradient"))
                        for i, (no, (a, m)) in enumerate(models.items())])
    return sums.select("slot", F.inline(entries)).select("config_no", "slot", (F.col("gradient") + 0.0).alias("gradient"))


# The reference's learning curves (family, parameter, values, the other parameters).
CURVES = [
    ("LinearRegression", "alpha", [0.01, 0.1, 1.0, 10.0, 100.0], {}),
    ("RandomForest", "n_estimators", [50, 100, 150, 200, 300], {"max_depth": 15, "min_samples_leaf": 5, "max_features": "all"}),
    ("XGBoost", "max_depth", [3, 4, 5, 6, 8, 10], {"n_estimators": 200, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8}),
    ("CatBoost", "iterations", [50, 100, 150, 200, 300], {"depth": 6, "learning_rate": 0.05, "border_count": 254}),
]


def curves_at(share: float = 1.0) -> list[tuple]:
    """The curves with a share of the trees and iterations at every point (1: the reference's)."""
    few = lambda v: max(2, round(v * share))
    return [(family, param, [few(v) for v in values] if param in ("n_estimators", "iterations") else values,
             {k: few(v) if k in ("n_estimators", "iterations") else v for k, v in base.items()}) for family, param, values, base in CURVES]


def curve_fits(family: str, param: str, values: Sequence[float], base: dict) -> list[tuple[Config, int | None]]:
    """(config, seed) of the fits a curve needs. Boosting: the largest alone, as every smaller
    one is its beginning. Forests: the stretches between the values, each with its own seed, as
    trees are independent and the first stretches together are the smaller forest."""
    cuts = sorted(values)
    if param == "iterations":
        cuts = cuts[-1:]
    if param == "n_estimators" and family == "RandomForest":
        return [(Config(family, i + 1, f"{param}={v}", {**base, param: v - low}), RANDOM_STATE + i) for i, (low, v) in enumerate(zip([0, *cuts], cuts))]
    return [(Config(family, i + 1, f"{param}={v}", {**base, param: v}), None) for i, v in enumerate(cuts)]


def parameter_curve(train: DataFrame, val: DataFrame, family: str, param: str, values: Sequence[float], base: dict, models: Sequence) -> DataFrame:
    """Train and validation RMSE for each value of one parameter; ``models``: those of ``curve_fits``."""
    spark, cuts = train.sparkSession, sorted(values)
    if param == "iterations":  # one pass gives the loss after every iteration
        loss = {s: models[0].evaluateEachIteration(d, "squared") for s, d in (("train", train), ("val", val))}
        rows = [(family, param, float(v), loss["train"][v - 1] ** 0.5, loss["val"][v - 1] ** 0.5) for v in cuts]
        return spark.createDataFrame(rows, "model string, param_name string, param_value double, train_rmse double, val_rmse double")
    scored = train.select("features", "label", F.lit("train").alias("split")).unionByName(val.select("features", "label", F.lit("val").alias("split")))
    for i, m in enumerate(models):
        scored = m.copy({m.predictionCol: f"p{i}"}).transform(scored)
    if param == "n_estimators" and family == "RandomForest":
        sizes = [v - low for low, v in zip([0, *cuts], cuts)]
        yhat = [sum((F.col(f"p{j}") * float(sizes[j]) for j in range(i + 1)), F.lit(0.0)) / float(v) for i, v in enumerate(cuts)]
    else:
        yhat = [F.col(f"p{i}") for i in range(len(cuts))]
    pairs = F.array(*[F.struct(F.lit(float(v)).alias("param_value"), y.alias("prediction")) for v, y in zip(cuts, yhat)])
    met = regression_metrics(scored.select("split", "label", F.inline(pairs)), ["param_value", "split"])
    wide = met.groupBy("param_value").agg(
        F.max(F.when(F.col("split") == "train", F.col("rmse"))).alias("train_rmse"),
        F.max(F.when(F.col("split") == "val", F.col("rmse"))).alias("val_rmse"))
    return wide.select(F.lit(family).alias("model"), F.lit(param).alias("param_name"), "param_value", "train_rmse", "val_rmse")


# ------------------------------------------------------------------ text classifier
@dataclass
class TextClassifier:
    """Fitted by ``fit_text_classifier``; ``path``: table of key, label, split, y, w and features."""
    path: str
    documents: DataFrame
    key: str
    model: object
    vocabulary: DataFrame
    penalty: float  # of the mean loss: penalty / 2 * ||b||^2
    n_train: int
    classes: tuple[str, str]  # positive, other

    def predictions(self) -> DataFrame:
        yes, no = self.classes
        scored = self.model.transform(self.documents)
        return scored.withColumn("prediction", F.when(F.col("prediction") == 1.0, yes).otherwise(no))


def sparse_documents(docs: DataFrame, key: str, weights: DataFrame, vocab: DataFrame, size: int) -> tuple[DataFrame, str]:
    """``docs`` plus ``features``: the (key, term, weight) entries of each row as a sparse vector. Also
    the folder of the table behind it.

    A vector is stored as a struct of its kind, width, places and values. The struct is put together
    by built-in functions and written to the shared folder; reading that table as a vector column
    makes it one, so no row passes through Python, and the solver's many passes start from the table.
    """
    entries = weights.join(F.broadcast(vocab.select("term", "idx")), "term") \
                     .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_e"))  # one doc's terms
    joined = docs.join(entries, key, "left").withColumn("_e", F.coalesce("_e", F.array().cast("array<struct<idx:int,weight:double>>")))
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform("_e", lambda e: e["idx"]).alias("indices"), F.transform("_e", lambda e: e["weight"]).alias("values"))
    path = scratch_path(docs.sparkSession, "documents-as-vectors")
    joined.select(*docs.columns, stored.alias("features")).write.parquet(path)
    schema = T.StructType([*docs.schema.fields, T.StructField("features", VectorUDT())])
    return docs.sparkSession.read.schema(schema).parquet(path), path


def fit_text_classifier(sp: DataFrame, key: str, text: str, label: str, positive: str, c_reg: float = 1.0,
                        max_iter: int = 500, tol: float = 1e-12) -> TextClassifier:
    """Balanced L2 logistic regression on TF-IDF 1-2-grams fitted on the train split.

    The penalised sum ``C * sum(w_i loss_i) + ||b||^2 / 2`` is ``C n`` times Spark's weighted mean loss
    with ``regParam = 1 / (C n)``; balanced weights ``n / (2 n_class)`` sum to n. ``tol`` bounds the
    relative change of the loss, not the gradient, so it is set far below the figures wanted.
    Rows without text or without any known term have an empty vector.
    """
    from tabprism.operators.text import tfidf
    train = sp.where(F.col("split") == "train")
    weights, vocab = tfidf(sp, key, text, vocab_from=train)
    vocab = cut_lineage(vocab)  # its size, the entries and the names of the coefficients all read it
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(3).collect()}
    if len(counts) != 2 or positive not in counts:
        raise ValueError(f"the train split needs two classes, {positive!r} one of them; it has {sorted(map(str, counts))}")
    n_train, other = sum(counts.values()), next(c for c in counts if c != positive)
    own = F.when(F.col(label) == positive, n_train / (2.0 * counts[positive])).otherwise(n_train / (2.0 * counts[other]))
    docs = sp.select(key, label, "split", (F.col(label) == positive).cast("double").alias("y"), own.alias("w"))
    docs, path = sparse_documents(docs, key, weights, vocab, vocab.count())
    penalty = 1.0 / (c_reg * n_train)
    lr = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", maxIter=max_iter,
                            regParam=penalty, elasticNetParam=0.0, standardization=False, tol=tol)
    return TextClassifier(path, docs, key, lr.fit(docs.where(F.col("split") == "train")), vocab, penalty, n_train, (positive, other))


def classifier_gradients(fit: TextClassifier) -> DataFrame:
    """(term, gradient) of the penalised mean loss by coefficient, the intercept as term null: the mean
    of ``w * (p - y) * x`` over the train rows plus the penalty's part, 0 at the optimum. Each row's own
    entries only, summed map-side first."""
    pull = F.col("w") * (vector_to_array("probability")[1] - F.col("y"))
    train = fit.model.transform(fit.documents.where(F.col("split") == "train")).select(fit.key, pull.alias("pull"))
    vector = "features struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"
    kind = fit.documents.schema[fit.key].dataType.simpleString()
    plain = fit.documents.sparkSession.read.schema(f"`{fit.key}` {kind}, {vector}").parquet(fit.path)
    entries = plain.select(fit.key, F.inline(F.arrays_zip(F.col("features.indices").alias("idx"), F.col("features.values").alias("x"))))
    sums = entries.join(train, fit.key).groupBy("idx").agg(F.sum(F.col("x") * F.col("pull")).alias("s"))
    slopes = fit.vocabulary.select("idx", "term").join(coefficients(fit), "idx").join(F.broadcast(sums), "idx", "left")
    slopes = slopes.select("term", (F.coalesce("s", F.lit(0.0)) / fit.n_train + F.col("coef") * fit.penalty).alias("gradient"))
    start = train.agg((F.sum("pull") / fit.n_train).alias("gradient")).select(F.lit(None).cast("string").alias("term"), "gradient")
    return slopes.unionByName(start).select("term", (F.col("gradient") + 0.0).alias("gradient"))


def coefficients(fit: TextClassifier) -> DataFrame:
    """(idx, coef): one row per vocabulary term, whose number the TF-IDF ``max_features`` bounds."""
    return fit.documents.sparkSession.createDataFrame(list(enumerate(fit.model.coefficients.toArray().tolist())), "idx int, coef double")


def top_terms(fit: TextClassifier, k: int = 15) -> DataFrame:
    """The k largest and k smallest coefficients with their terms."""
    j = coefficients(fit).join(fit.vocabulary.select("term", "idx"), "idx")
    pos = j.orderBy(F.desc("coef"), "term").limit(k).withColumn("side", F.lit("positive"))
    neg = j.orderBy(F.asc("coef"), "term").limit(k).withColumn("side", F.lit("negative"))
    return pos.unionByName(neg).select("side", "term", "coef")
