"""Fitted preprocessor and models of a data folder, made once per session and kept on the driver.

The explanation queries, the predictions and the saved artefacts all speak of the same models;
a fit is far dearer than anything done with it. Models are as large as their trees, not as the
data. Prepared splits are checkpointed in the shared folder, not held in memory.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.functions.scalar import CATEGORICAL_FEATURES, NUMERICAL_FEATURES
from tabprism.operators import attribution as A
from tabprism.operators import models as M
from tabprism.operators.features import FittedPreprocessor
from tabprism.plans.prep_plans import prepared, split_frame
from tabprism.session import cut_lineage

FAMILIES = ("LinearRegression", "RandomForest", "XGBoost", "CatBoost")
# Per family the config that is explained: ridge alpha = 1, and the first of each ensemble.
EXPLAINED = {"LinearRegression": 3, "RandomForest": 1, "XGBoost": 1, "CatBoost": 1}


@dataclass
class Store:
    prep: DataFrame  # listing_id, split, features, label
    raw: DataFrame  # listing_id, split and the raw feature columns
    pre: FittedPreprocessor
    models: dict[tuple, object] = field(default_factory=dict)
    space: A.FeatureSpace | None = None
    made: dict[str, DataFrame] = field(default_factory=dict)

    def split(self, *names: str) -> DataFrame:
        return self.prep.where(F.col("split").isin(*names)).select("features", "label")

    def fitted(self, configs: list[M.Config], seeds: list | None = None) -> dict[tuple, object]:
        """The configs' models; those that are not there yet are fitted side by side."""
        seeds = seeds or [None] * len(configs)
        new = [(c, s) for c, s in zip(configs, seeds) if M.applied(c, s) not in self.models]
        if new:
            self.models |= M.fit_all(self.split("train"), [c for c, _ in new], [s for _, s in new])
        return self.models

    def explained_models(self, families: Sequence[str] = FAMILIES) -> dict[str, object]:
        """Model by family; only the named families are fitted."""
        own = [c for c in M.model_grid() if EXPLAINED[c.family] == c.no and c.family in families]
        fitted = self.fitted(own)
        return {c.family: fitted[M.applied(c)] for c in own}

    def feature_space(self) -> A.FeatureSpace:
        if self.space is None:
            self.space = A.feature_space(self.raw.where(F.col("split") == "train"), self.pre)
        return self.space


STORED_ROWS = 50_000  # rows a task, up to the session's cores


def spread(rows: DataFrame) -> DataFrame:
    """Materialised rows over as many cores as their number asks for. A table is read in as few tasks
    as its compressed bytes ask for, and all that follows on its rows would run in as few."""
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // STORED_ROWS)
    return cut_lineage(rows.repartition(parts)) if parts > rows.rdd.getNumPartitions() else rows


_stores: dict[tuple[str, str], Store] = {}
_lock = threading.Lock()


def store(spark: SparkSession, sf: str) -> Store:
    """The folder's store in this session (one application)."""
    key = (spark.sparkContext.applicationId, sf)
    with _lock:
        if key not in _stores:
            # Joined once: every action on the joined frame would send the customers to the driver and back again.
            rows = spread(cut_lineage(split_frame(spark, sf, learnable=True).select("listing_id", "split", "y", *NUMERICAL_FEATURES, *CATEGORICAL_FEATURES)))
            prep, pre = prepared(spark, sf, sp=rows)
            _stores[key] = Store(cut_lineage(prep.select("listing_id", "split", "features", "label")), rows.drop("y"), pre)
        return _stores[key]
