"""Local explanations of any fitted regressors over raw columns (section 2J).

A feature is a raw column: a numeric one is one slot of the model's vector, a categorical one
a whole block of slots. Perturbed rows are made of raw values and run through the fitted
preprocessor, so blocks never fall apart. All models are scored on the same rows.

* LIME: per observation and setting, ``n`` rows drawn by inverse CDF: a normal one with the
  train mean and std, or the train frequencies of the categories; ``lhs`` draws one uniform
  from each of ``n`` strata. The surrogate sees "same quartile bin" or "same category" and is a
  weighted ridge. It is solved from sums of products, one aggregate per observation and
  setting, by elimination on a small array: no Python and no group of rows in one task.
* Sampled Shapley values: pairs of a feature order and its reverse; along an order features
  go over from a background row to the observation. A scored row adds its prediction to the
  feature that just came and takes it from the next one, so values are sums, without a window.
  Features that are the same in both rows are not scored: their step is 0. Linear and tree
  models over many rows are walked once for all steps instead (``tree_walk``).
  The spread between pairs gives a standard error; values sum exactly to the prediction minus
  the mean prediction of the background rows.

Every draw is a hash of (observation, setting, sample, feature).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprism.operators.explain import normal_ppf
from tabprism.operators.features import FittedPreprocessor
from tabprism.operators.quantiles import exact_quantiles
from tabprism.operators.sampling import hash_order
from tabprism.operators.stats import to_long
from tabprism.operators.tree_walk import shap_by_walk, walkable
from tabprism.session import cut_lineage


def unit(*parts: Column) -> Column:
    """A uniform in (0, 1) from a hash of the parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / float(2 ** 52)


@dataclass
class FeatureSpace:
    """What drawing needs to know of the train rows; bounded by the columns and categories."""

    pre: FittedPreprocessor
    quartiles: dict[str, tuple[float, float, float]]
    frequencies: dict[str, tuple[list[str], list[float]]]  # categories and cumulated shares

    @property
    def features(self) -> list[str]:
        return self.pre.numeric + self.pre.categorical


def feature_space(train: DataFrame, pre: FittedPreprocessor) -> FeatureSpace:
    """Quartiles of the imputed numeric columns and shares of the imputed categories of ``train``."""
    num = [F.coalesce(F.col(c).cast("double"), F.lit(pre.medians[c])).alias(c) for c in pre.numeric]
    q = exact_quantiles(to_long(train.select(*num), [], pre.numeric), "value", [0.25, 0.5, 0.75], ["feature"], ["a", "b", "c"])
    cat = [F.coalesce(F.col(c), F.lit(pre.modes[c])).alias(c) for c in pre.categorical]
    counts = to_long(train.select(*cat), [], pre.categorical).groupBy("feature", "value").count()
    w = Window.partitionBy("feature").orderBy("value")  # over the categories, which the preprocessor bounds
    shares = counts.withColumn("share", F.sum("count").over(w) / F.sum("count").over(Window.partitionBy("feature")))
    found: dict[str, tuple[list[str], list[float]]] = {c: ([], []) for c in pre.categorical}
    for r in sorted(shares.collect(), key=lambda r: (r["feature"], r["share"])):
        found[r["feature"]][0].append(r["value"])
        found[r["feature"]][1].append(r["share"])
    return FeatureSpace(pre, {r["feature"]: (r["a"], r["b"], r["c"]) for r in q.collect()}, found)


def score(rows: DataFrame, pre: FittedPreprocessor, models: dict[str, object], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus one prediction column per model, for rows of raw columns."""
    return predicted(pre.transform(rows).select(*keep, "features"), models, keep)


def predicted(rows: DataFrame, models: dict[str, object], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus one prediction column per model, for rows of vectors."""
    for name, model in models.items():
        rows = model.copy({model.predictionCol: f"p_{name}"}).transform(rows)
    return rows.select(*keep, *[f"p_{name}" for name in models])


# ---- LIME -----------------------------------------------------------------------------------


def ridge_from_sums(sums: DataFrame, keys: Sequence[str], features: Sequence[str], targets: Sequence[str], alpha: float = 1.0) -> DataFrame:
    """(keys, target, feature, weight): ridges with intercept from the columns ``w``, ``z_i``,
    ``z_i_j`` (i <= j), ``y_t`` and ``z_i_y_t``, sums over rows with weight w."""
    n = len(features)
    # As SQL text: some hundred cells. One elimination with a right-hand side per target.
    cells = [[f"z_{min(i, j)}_{max(i, j)} - z_{i} * z_{j} / w + {float(alpha) if i == j else 0.0}" for j in range(n)] + [f"z_{i}_y_{t} - z_{i} * y_{t} / w" for t in targets] for i in range(n)]
    matrix = "array(" + ", ".join("array(" + ", ".join(row) + ")" for row in cells) + ")"
    own = sums.select(*keys, F.expr(matrix).alias("m"))
    own = own.select(*keys, F.expr(f"""aggregate(sequence(0, {n - 1}), m, (a, k) -> transform(a, (r, i) ->
        IF(i = k, transform(r, v -> v / a[k][k]), zip_with(r, a[k], (x, y) -> x - r[k] * y / a[k][k]))))""").alias("m"))
    sides = F.array(*[F.struct(F.lit(t).alias("model"), F.expr(f"transform(m, r -> r[{n + i}])").alias("own")) for i, t in enumerate(targets)])
    named = F.arrays_zip(F.array(*map(F.lit, features)).alias("feature"), F.col("own").alias("weight"))
    return own.select(*keys, F.inline(sides)).select(*keys, "model", F.inline(named))


def perturbed(obs: DataFrame, space: FeatureSpace, settings: Sequence[tuple[int, float, str]], key: str) -> DataFrame:
    """(obs_id, setting, kernel_width, z: array of 0/1 per feature, raw columns) for each drawn row."""
    pre, nf = space.pre, len(space.features)
    own = obs.select(F.col(key).alias("obs_id"), *[F.coalesce(F.col(c).cast("double"), F.lit(pre.medians[c])).alias(f"o_{c}") for c in pre.numeric],
                     *[F.coalesce(F.col(c), F.lit(pre.modes[c])).alias(f"o_{c}") for c in pre.categorical])
    table = F.array(*[F.struct(F.lit(i).alias("setting"), F.lit(n).alias("n"), F.lit(float(kw)).alias("kernel_width"), F.lit(s).alias("sampling"))
                      for i, (n, kw, s) in enumerate(settings)])
    own = own.select("*", F.inline(table))
    # Strata: per feature an order of the sample numbers. Gaussian rows use the number alone.
    orders = [F.expr(f"transform(array_sort(transform(sequence(0, n - 1), s -> struct(xxhash64(obs_id, n, s, {j}, 'order') AS h, s AS s))), x -> x.s)").alias(f"r{j}") for j in range(nf)]
    own = own.select("*", F.expr("sequence(0, n - 1)").alias("s"), *orders)
    own = own.withColumn("cell", F.explode(F.arrays_zip("s", *[f"r{j}" for j in range(nf)]))).drop("s", *[f"r{j}" for j in range(nf)])
    s = F.col("cell.s")
    draws = []
    for j in range(nf):
        u = unit(F.col("obs_id"), F.col("n"), s, F.lit(j), F.lit("draw"))
        draws.append(F.when(F.col("sampling") == "lhs", (F.col(f"cell.r{j}") + u) / F.col("n")).otherwise(u).alias(f"u{j}"))
    own = own.select("*", s.alias("sample"), *draws)
    raw, same = [], []
    for j, c in enumerate(space.features):
        if c in space.frequencies:
            names, shares = space.frequencies[c]
            at = F.least(F.size(F.filter(F.array(*map(F.lit, shares)), lambda x: x < F.col(f"u{j}"))) + 1, F.lit(len(names)))
            drawn = F.element_at(F.array(*map(F.lit, names)), at)
        else:
            drawn = F.lit(pre.means[c]) + F.lit(pre.stds[c]) * normal_ppf(F.col(f"u{j}"))
        raw.append(F.when(F.col("sample") == 0, F.col(f"o_{c}")).otherwise(drawn).alias(c))
    own = own.select("obs_id", "setting", "kernel_width", *[f"o_{c}" for c in space.features], *raw)
    for c in space.features:
        if c in space.frequencies:
            same.append((F.col(c) == F.col(f"o_{c}")).cast("double"))
        else:
            place = lambda v, c=c: sum(((v > F.lit(e)).cast("int") for e in space.quartiles[c]), F.lit(0))
            same.append((place(F.col(c)) == place(F.col(f"o_{c}"))).cast("double"))
    return own.select("obs_id", "setting", "kernel_width", F.array(*same).alias("z"), *space.features)


DRAWN = ["obs_id", "setting", "kernel_width", "z"]


def lime_rows(obs: DataFrame, space: FeatureSpace, settings: Sequence[tuple[int, float, str]], key: str = "listing_id") -> DataFrame:
    """The drawn rows of every observation and setting with their vectors, written: no model is needed
    for them, so they can be made while the models are fitted. ``n`` rows an observation and setting."""
    return cut_lineage(space.pre.transform(perturbed(obs, space, settings, key)).select(*DRAWN, "features"))


def lime_weights(models: dict[str, object], obs: DataFrame, space: FeatureSpace, settings: Sequence[tuple[int, float, str]],
                 key: str = "listing_id", alpha: float = 1.0, rows: DataFrame | None = None) -> DataFrame:
    """(model, obs_id, n_samples, kernel_width, sampling, feature, weight) for every row of
    ``obs`` and every setting ``(n, kernel width, sampling)``; ``rows``: those of ``lime_rows``, if they
    are there already."""
    feats = space.features
    scored = predicted(lime_rows(obs, space, settings, key) if rows is None else rows, models, DRAWN)
    far = F.aggregate("z", F.lit(0.0), lambda a, x: a + 1.0 - x)
    scored = scored.withColumn("k", F.sqrt(F.exp(-far / (F.col("kernel_width") * F.col("kernel_width")))))
    n = range(len(feats))
    sums = ["sum(k) AS w", *[f"sum(k * z[{i}]) AS z_{i}" for i in n], *[f"sum(k * z[{i}] * z[{j}]) AS z_{i}_{j}" for i in n for j in n if i <= j]]
    for m in models:
        sums += [f"sum(k * p_{m}) AS y_{m}", *[f"sum(k * z[{i}] * p_{m}) AS z_{i}_y_{m}" for i in n]]
    sums = [F.expr(x) for x in sums]
    solved = ridge_from_sums(scored.groupBy("obs_id", "setting").agg(*sums), ["obs_id", "setting"], feats, list(models), alpha)
    meta = F.array(*[F.struct(F.lit(n).alias("n_samples"), F.lit(float(kw)).alias("kernel_width"), F.lit(s).alias("sampling")) for n, kw, s in settings])
    return solved.withColumn("m", meta[F.col("setting")]).select("model", "obs_id", "m.n_samples", "m.kernel_width", "m.sampling", "feature", "weight")


# ---- sampled Shapley values --------------------------------------------------------------------


def background_rows(train: DataFrame, features: Sequence[str], n: int, key: str = "listing_id", seed: int = 42) -> DataFrame:
    """(b, raw columns): ``n`` train rows by hash order, numbered; ``n`` bounds the table."""
    picked = train.orderBy(hash_order(key, seed), key).limit(n).select(key, *features)
    w = Window.orderBy(hash_order(key, seed), key)  # over the n picked rows
    return picked.select((F.row_number().over(w) - 1).alias("b"), *features)


SHAP_TASK_ROWS = 1_000  # observations a task: each is scored 2 * pairs * (features + 1) times
WALKED_FROM, WALK_TASK_ROWS = 1_000, 4_000  # observations from which the trees are walked, and at most a task


def shap_weights(models: dict[str, object], obs: DataFrame, background: DataFrame, n_background: int, pre: FittedPreprocessor,
                 pairs: int = 5, key: str = "listing_id") -> DataFrame:
    """(model, obs_id, feature, weight, std_error); pair p uses background row p % n_background.

    Observations are dealt by key to tasks sized by the scoring, not by the table's bytes; the sums are
    then made where the rows were scored, without another shuffle. From ``WALKED_FROM`` observations on,
    linear and tree models are not scored step by step but walked once for all steps (``tree_walk``); few
    rows are scored sooner than the trees are read, and other models have no nodes to walk."""
    feats = pre.numeric + pre.categorical
    nf, n = len(feats), obs.count()
    arrays = walkable(obs.sparkSession, models) if n >= WALKED_FROM else None
    if arrays is not None:
        cores = obs.sparkSession.sparkContext.defaultParallelism
        dealt = obs.select(key, *feats).repartition(cores * -(-n // (cores * WALK_TASK_ROWS)), key)
        slots = [1] * len(pre.numeric) + [len(pre.categories[c]) for c in pre.categorical]
        return shap_by_walk(arrays, list(models), pre.transform(dealt).select(key, "features"), pre.transform(background), n_background, slots, feats, pairs, key)
    obs = obs.select(key, *feats).repartition(max(1, -(-n // SHAP_TASK_ROWS)), key)
    own = obs.select(F.col(key).alias("obs_id"), F.struct(*[F.col(c) for c in feats]).alias("o"))
    own = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(pairs - 1))).alias("pair"))
    order = F.transform(F.array_sort(F.array(*[F.struct(F.xxhash64("obs_id", "pair", F.lit(j)).alias("h"), F.lit(j).alias("j")) for j in range(nf)])), lambda x: x["j"])
    own = own.select("*", order.alias("way")).select("obs_id", "o", "pair", F.explode(F.array("way", F.reverse("way"))).alias("way"))
    low = background.select("b", F.struct(*feats).alias("g"))
    own = own.join(F.broadcast(low), F.col("pair") % n_background == F.col("b"))  # n_background rows
    # A feature that is the same in both rows makes no step: its row would be the one before it again.
    same = F.array(*[F.col("o")[c].eqNullSafe(F.col("g")[c]) for c in feats])
    own = own.select("obs_id", "pair", "o", "g", "way", same.alias("same"))
    own = own.select("obs_id", "pair", "o", "g", F.expr("filter(way, j -> NOT same[j])").alias("way"), F.expr("filter(way, j -> same[j])").alias("still"))
    own = own.select("obs_id", "pair", "o", "g", "way", "still", F.explode(F.sequence(F.lit(0), F.size("way"))).alias("k"))
    place = F.transform(F.sequence(F.lit(0), F.lit(nf - 1)), lambda j: F.array_position("way", j.cast("int")))
    own = own.select("obs_id", "pair", "k", "way", "still", "o", "g", place.alias("at"))
    raw = [F.when(F.col("at")[j] <= F.col("k"), F.col("o")[c]).otherwise(F.col("g")[c]).alias(c) for j, c in enumerate(feats)]
    moves = F.expr("""concat(filter(array(struct(get(way, k - 1) AS j, 1D AS sign), struct(get(way, k) AS j, -1D AS sign)), x -> x.j IS NOT NULL),
                             IF(k = 0, transform(still, j -> struct(j AS j, 0D AS sign)), array()))""")
    scored = score(own.select("obs_id", "pair", moves.alias("moves"), *raw), pre, models, ["obs_id", "pair", "moves"])
    names = list(models)
    steps = scored.select("obs_id", "pair", F.array(*[f"p_{m}" for m in names]).alias("p"), F.inline("moves"))
    of_pair = steps.groupBy("obs_id", "pair", "j").agg(*[(F.sum(F.col("sign") * F.col("p")[i]) / 2).alias(f"d{i}") for i in range(len(names))])
    done = of_pair.groupBy("obs_id", "j").agg(*[F.struct(F.lit(m).alias("model"), F.avg(f"d{i}").alias("weight"),
                                                        (F.stddev_samp(f"d{i}") / F.sqrt(F.count(F.lit(1)))).alias("std_error")).alias(f"m{i}") for i, m in enumerate(names)])
    out = done.select("obs_id", F.array(*[F.lit(c) for c in feats])[F.col("j")].alias("feature"), F.inline(F.array(*[f"m{i}" for i in range(len(names))])))
    return out.select("model", "obs_id", "feature", "weight", "std_error")


# ---- one row per explanation -----------------------------------------------------------------


def packed(weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per explanation: ``weights``, an array of (feature, weight), largest |weight| first
    (ties by feature). As many entries as features, so what ranks or compares them needs no shuffle."""
    entry = F.struct((-F.abs("weight")).alias("less"), "feature", "weight")
    listed = weights.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("w"))
    return listed.select(*keys, F.transform("w", lambda x: F.struct(x["feature"].alias("feature"), x["weight"].alias("weight"))).alias("weights"))


def top_of(explained: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """E5: the ``k`` largest entries of each explanation, ranked from 1."""
    return explained.select(*keys, F.posexplode(F.slice("weights", 1, k)).alias("r", "x")).select(
        *keys, "x.feature", "x.weight", (F.col("r") + 1).alias("rnk"))


def overlap_of(left: Column, right: Column, k: int) -> Column:
    """shared share of the ``k`` largest features of two explanations."""
    a, b = (F.transform(F.slice(x, 1, k), lambda e: e["feature"]) for x in (left, right))
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.round(F.size(F.array_intersect(a, b)) / both, 4)).otherwise(0.0)


def sensitivity_table(explained: DataFrame, keys: Sequence[str], setting: str, settings: Sequence, k: int = 5) -> DataFrame:
    """per explained row, the ``k`` first features met in the settings' top-k lists (settings in
    the order given), each with one column per setting: its weight, 0 where it is not in that list."""
    tops = [F.col(f"s{i}") for i in range(len(settings))]
    wide = explained.groupBy(*keys).agg(*[F.first(F.when(F.col(setting) == v, F.slice("weights", 1, k)), ignorenulls=True).alias(f"s{i}")
                                          for i, v in enumerate(settings)])
    names = F.array_distinct(F.flatten(F.array(*[F.transform(F.coalesce(t, F.expr("CAST(array() AS array<struct<feature:string,weight:double>>)")), lambda x: x["feature"]) for t in tops])))
    rows = wide.select("*", F.posexplode(F.slice(names, 1, k)).alias("r", "feature"))
    weight = [F.coalesce(F.get(F.filter(t, lambda x: x["feature"] == F.col("feature")), F.lit(0))["weight"], F.lit(0.0)).alias(f"weight_{i + 1}") for i, t in enumerate(tops)]
    return rows.select(*keys, (F.col("r") + 1).alias("rnk"), "feature", *weight)
