"""How many fits run side by side, and in which partitions."""

import threading

import pytest
from pyspark.ml.linalg import Vectors

from tabprism.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(Vectors.sparse(5, [0, 1 + i % 4], [i % 7 / 3, 1.0]), float(i % 11) + i % 4) for i in range(400)], ["features", "label"]).repartition(2).checkpoint()


def boosted(n):
    return [M.Config("XGBoost", i, "b", {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.1 + i / 10, "subsample": 1.0, "colsample_bytree": 1.0}) for i in range(n)]


def test_fits_whose_rows_fill_the_memory_wait_for_each_other(rows, monkeypatch):
    real, lock, now, most = M.estimator, threading.Lock(), [0], [0]

    def watched(*args):
        est = real(*args)
        fit = est.fit

        def counted(df):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            try:
                return fit(df)
            finally:
                with lock:
                    now[0] -= 1

        est.fit = counted
        return est

    monkeypatch.setattr(M, "estimator", watched)
    cfgs = boosted(4)
    want = M.fit_all(rows, cfgs)
    assert most[0] > 1  # small rows: side by side, as before
    most[0] = 0
    monkeypatch.setattr(M, "cache_bytes", lambda spark: 3 * M.binned_bytes(cfgs[0], 400, 5))
    got = M.fit_all(rows, cfgs)
    assert most[0] == 1 and list(got) == list(want)
    assert all(got[k].toDebugString.split("\n")[1:] == want[k].toDebugString.split("\n")[1:] for k in want)


def test_bound_counts_rows_slots_and_trees(spark):
    ridge, forest, boost = (next(c for c in M.model_grid() if c.family == f) for f in ("LinearRegression", "RandomForest", "XGBoost"))
    assert M.binned_bytes(ridge, 10**9, 179) == 0
    assert M.binned_bytes(boost, 5_293_918, 179) > 4e9  # as much as Spark's own integers
    assert M.binned_bytes(forest, 1000, 179) - M.binned_bytes(boost, 1000, 179) == 1000 * 4 * 100
    assert M.at_once(4 * 10**9, 10 * 10**9) == 1 and M.at_once(4 * 10**8, 10 * 10**9) == 8
    assert M.at_once(10**12, 10**9) == 1 and M.at_once(0, 10**9) == M.FITS_AT_ONCE
    assert M.cache_bytes(spark) > 10**8


def test_more_partitions_than_cores_become_whole_waves(spark):
    cores = spark.sparkContext.defaultParallelism
    table = spark.range(1000)
    assert M.sized(table.repartition(cores + 1), 1000, 1).rdd.getNumPartitions() == 2 * cores
    assert M.sized(table.repartition(2 * cores), 1000, 1).rdd.getNumPartitions() == 2 * cores
    sizes = M.sized(table.repartition(cores + 1), 1000, 1).rdd.glom().map(len).collect()
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= cores + 1
    assert M.sized(table.repartition(cores), 1000, 500).rdd.getNumPartitions() == 2  # small tables as before
