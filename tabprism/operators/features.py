"""Feature preparation (section 2H): fit statistics on the train split, apply anywhere.

The fitted state is small and bounded by the feature catalog (one median, mean, std,
mode per column; one label list per categorical column), just like the state of a
Spark ML estimator. Fitting runs as distributed aggregates (exact medians via the
distributed quantiles); applying is a fitted ``PipelineModel`` (SQL expression stage
for impute+scale, ``StringIndexerModel`` + ``OneHotEncoder`` + ``VectorAssembler``),
which can be saved and loaded (A7).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.operators.quantiles import exact_quantiles
from tabprism.operators.stats import to_long


def fit_medians(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H3: exact train median per numeric column -> (feature, median)."""
    lng = to_long(train.select(*cols), [], cols)
    return exact_quantiles(lng, "value", [0.5], ["feature"], ["median"]).drop("n")


def impute_expr(col: str, median: float):
    return F.coalesce(F.col(col), F.lit(median))


def fit_scaling(train: DataFrame, cols: Sequence[str], medians: dict[str, float]) -> DataFrame:
    """H4: mean and population std of the imputed train columns (std 0 -> 1)."""
    lng = to_long(train.select(*[impute_expr(c, medians[c]).alias(c) for c in cols]), [], cols)
    st = lng.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return st.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def fit_modes(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H5: most frequent train value per categorical column; ties -> smallest value."""
    lng = to_long(train.select(*cols), [], cols)
    counts = lng.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def fit_categories(train: DataFrame, cols: Sequence[str], modes: dict[str, str]) -> DataFrame:
    """H6: sorted distinct imputed train categories per column -> (feature, category, pos)."""
    imputed = train.select(*[F.coalesce(F.col(c), F.lit(modes[c])).alias(c) for c in cols])
    lng = to_long(imputed, [], cols, value="category").distinct()
    from pyspark.sql import Window
    w = Window.partitionBy("feature").orderBy("category")  # over distinct categories only
    return lng.withColumn("pos", F.row_number().over(w) - 1)


MAX_CATEGORIES = 100_000  # labels the driver holds; they become the width of the vectors


@dataclass
class FittedPreprocessor:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]
    modes: dict[str, str]
    categories: dict[str, list[str]]
    model: PipelineModel | None = field(default=None)

    def feature_names(self) -> list[str]:
        """H8: numeric names, then ``column_category`` per sorted category."""
        return list(self.numeric) + [f"{c}_{v}" for c in self.categorical for v in self.categories[c]]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def _stage_sql(num, cat, medians, means, stds, modes) -> str:
    parts = ["*"]
    for c in num:
        parts.append(f"(coalesce(`{c}`, {medians[c]!r}) - {means[c]!r}) / {stds[c]!r} AS `_s_{c}`")
    for c in cat:
        mode = modes[c].replace("'", "''")
        parts.append(f"coalesce(`{c}`, '{mode}') AS `_i_{c}`")
    return "SELECT " + ", ".join(parts) + " FROM __THIS__"


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     features_col: str = "features") -> FittedPreprocessor:
    """H7: impute (median / mode) -> scale -> one-hot -> assemble, fitted on ``train``.

    The fitted parameters are collected (they are bounded by the catalog size), then
    frozen into a ``PipelineModel``; unseen categories map to an all-zero block.
    """
    num, cat = list(numeric), list(categorical)
    med = {r["feature"]: r["median"] for r in fit_medians(train, num).collect()}
    sc = {r["feature"]: (r["mean"], r["std"]) for r in fit_scaling(train, num, med).collect()}
    modes = {r["feature"]: r["mode"] for r in fit_modes(train, cat).collect()}
    cats_rows = fit_categories(train, cat, modes).limit(MAX_CATEGORIES + 1).collect()
    if len(cats_rows) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories; hash or drop the widest columns first")
    cats = {c: [r["category"] for r in sorted((r for r in cats_rows if r["feature"] == c), key=lambda r: r["pos"])]
            for c in cat}
    means = {c: sc[c][0] for c in num}
    stds = {c: sc[c][1] for c in num}
    stages = [SQLTransformer(statement=_stage_sql(num, cat, med, means, stds, modes))]
    for c in cat:
        stages.append(StringIndexerModel.from_labels(cats[c], inputCol=f"_i_{c}", outputCol=f"_x_{c}",
                                                     handleInvalid="keep"))
    head = PipelineModel(stages)
    encoder = OneHotEncoder(inputCols=[f"_x_{c}" for c in cat], outputCols=[f"_o_{c}" for c in cat],
                            dropLast=True, handleInvalid="error")
    enc_model = encoder.fit(head.transform(train.limit(1)))  # sizes come from the indexer metadata
    assembler = VectorAssembler(inputCols=[f"_s_{c}" for c in num] + [f"_o_{c}" for c in cat],
                                outputCol=features_col)
    model = PipelineModel(stages + [enc_model, assembler])
    return FittedPreprocessor(num, cat, med, means, stds, modes, cats, model)
