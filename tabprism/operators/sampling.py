"""Seeded sampling, outlier filtering and splits.

Randomness is a hash of (key, seed), never ``rand()``: the same rows are chosen
under any partitioning, after a retry, and in the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_order(key: str, seed: int) -> Column:
    """A per-row pseudo-random sort key: md5 of ``key|seed`` (hex string)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def hash_uniform_bucket(key: str, seed: int, modulus: int) -> Column:
    """``first 8 hex digits of md5(key|seed)`` as an integer, modulo ``modulus``."""
    h8 = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h8, F.lit(modulus))


def sample_exact(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by hash order.

    Planned as ``TakeOrderedAndProject``: each task keeps its own best ``n`` and only
    those are merged, so the driver never sees more than ``n`` x tasks rows.
    """
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)


def remove_outliers(df: DataFrame, c: str, z: float = 3.5) -> DataFrame:
    """Keep rows with ``|c - mean| / std_pop < z`` over the whole frame.

    The two statistics are one scalar subquery (evaluated once, inlined as
    literals), so the filter is a plain predicate on the scan side.
    """
    st = df.select(F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"))).scalar()
    return df.where(F.abs((F.col(c) - st["m"]) / st["s"]) < z)


def split3(df: DataFrame, key: str, seed: int = 42, train: int = 6, val: int = 2) -> DataFrame:
    """H1: train/val/test = 60/20/20 by hash bucket (0-5 / 6-7 / 8-9)."""
    b = hash_uniform_bucket(key, seed, 10)
    split = F.when(b < train, "train").when(b < train + val, "val").otherwise("test")
    return df.withColumn("split", split)


def split_stratified(df: DataFrame, key: str, label: str, test_frac: float = 0.2, seed: int = 42,
                     by: Sequence[str] = ()) -> DataFrame:
    """H2: exact per-class test share ``ceil(test_frac * n_class)`` by hash rank.

    The rank within each class is computed with the distributed rank of
    :func:`ranked_counts` (value ranges split a big class over many tasks) instead of
    a ``row_number`` window holding a whole class in one task.
    """
    from tabprism.operators.quantiles import ranked_counts
    keyed = df.withColumn("_h", hash_order(key, seed))  # the full hash: no ties among keys
    rc = ranked_counts(keyed.select(label, "_h"), "_h", [label, *by])
    cut = F.ceil(F.lit(test_frac) * F.col("_n"))
    ranks = rc.select(label, *by, "_h", (F.col("_before") < cut).alias("_test"))
    out = keyed.join(ranks, [label, *by, "_h"])
    return out.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_h", "_test")
