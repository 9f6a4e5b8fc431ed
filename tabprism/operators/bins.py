"""Binning operators (section 2C) and label-domain alignment (F1).

All statistics that a bin layout depends on (global max, min/max, p99) are computed
as one-row aggregates and inlined as scalar subqueries, so the big side is never
joined or windowed globally. Per-row work is a generated CASE chain or plain
arithmetic inside whole-stage codegen, followed by one partial+final aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprism.functions.binning import (BinSpec, bin_table, left_closed_position,
                                        right_closed_bin)
from tabprism.operators.attach import attach


def reindex_counts(counts: DataFrame, spec: BinSpec, key: str = "ord", n: str = "n",
                   by: Sequence[str] = ()) -> DataFrame:
    """align counts to the full label list, missing -> 0 (left outer join).

    The label table has a fixed size (len(spec.labels) rows). With ``by`` groups the
    domain is the product of the groups seen and the labels: a bounded fan-out of
    ``len(labels)`` per group, not a pairing of data rows.
    """
    spark = counts.sparkSession
    labels = bin_table(spark, spec).select(F.col("ord").alias(key), "label")
    if by:
        groups = counts.select(*by).distinct()
        domain = groups.select(*by, F.explode(F.array(*[F.lit(o) for o, *_ in spec.intervals()])).alias(key))
        domain = domain.join(F.broadcast(labels), key)
        out = domain.join(counts, [*by, key], "left")
    else:
        out = labels.join(counts, key, "left")
    return out.withColumn(n, F.coalesce(F.col(n), F.lit(0).cast(T.LongType())))


def bucket_counts(df: DataFrame, value: Column | str, spec: BinSpec, by: Sequence[str] = ()) -> DataFrame:
    """Rows per right-closed bin for every label in order, with share in percent."""
    v = F.col(value) if isinstance(value, str) else value
    # out of range is ordinal 0, which no label has: a filter on the ordinal would be
    # pushed down and copy the whole CASE chain into the scan filter
    binned = df.select(*by, v.alias("_v")).select(*by, F.coalesce(right_closed_bin(F.col("_v"), spec), F.lit(0)).alias("ord"))
    counts = binned.groupBy(*by, "ord").agg(F.count(F.lit(1)).alias("n"))
    out = reindex_counts(counts, spec, by=by)
    # share over the (tiny, already aggregated) per-group label rows
    from pyspark.sql import Window
    w = Window.partitionBy(*by)
    total = F.sum("n").over(w)
    share = F.when(total > 0, F.col("n") * F.lit(100.0) / total)
    return out.select(*by, "ord", "label", "n", share.alias("share"))


def bucket_position(stat: Column, spec: BinSpec) -> Column:
    """Position of a statistic on the bin axis ([lo, hi), else the last bin)."""
    return left_closed_position(stat, spec)


def binned_mean(df: DataFrame, value: Column | str, spec: BinSpec, target: str) -> DataFrame:
    """Mean target per non-empty right-closed bin of ``value``."""
    v = F.col(value) if isinstance(value, str) else value
    binned = df.select(v.alias("_v"), F.col(target)).select(
        F.coalesce(right_closed_bin(F.col("_v"), spec), F.lit(0)).alias("ord"), F.col(target))
    agg = binned.groupBy("ord").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean_target"))
    labels = bin_table(df.sparkSession, spec).select("ord", "label")
    return agg.join(F.broadcast(labels), "ord").select("ord", "label", "n", "mean_target")


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed
    (``numpy.histogram`` semantics), every bin reported (empty ones as 0).

    Without groups the range comes from one scalar subquery; with groups from a
    per-group aggregate attached to the rows (see :mod:`attach`).
    """
    by = list(by)
    data = df.select(*by, value).where(F.col(value).isNotNull())
    for b in by:
        data = data.where(F.col(b).isNotNull())
    if by:
        rng = data.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        data = attach(data, rng, by)
        lo, hi = F.col("_lo"), F.col("_hi")
    else:
        mm = data.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
        lo, hi = mm["lo"], mm["hi"]
        rng = None
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - lo) / width), F.lit(bins - 1)).cast("int"))
    counts = data.select(*by, idx.alias("bin")).groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    if by:
        domain = rng.select(*by, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        blo, bhi = F.col("_lo"), F.col("_hi")
    else:
        domain = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        blo, bhi = lo, hi
    w = (bhi - blo) / F.lit(float(bins))
    out = domain.join(counts, [*by, "bin"], "left")
    return out.select(*by, "bin",
                      (blo + F.col("bin") * w).alias("bin_lo"),
                      (blo + (F.col("bin") + 1) * w).alias("bin_hi"),
                      F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("n"))


def hexbin_mean(df: DataFrame, x: str, y: str, c: str, gridsize: int = 40) -> DataFrame:
    """Hexagon grid over (x, y) with the mean of ``c`` per occupied hexagon.

    Two offset rectangular lattices; each point goes to the nearer centre by
    ``dx^2 + 3 dy^2`` (the hexagon metric). Extents are one scalar subquery.
    Output: lattice (1 or 2), i, j, centre coordinates, n, mean.
    """
    nx = gridsize
    ny = int(nx / math.sqrt(3))
    data = df.select(x, y, c).dropna()
    ext = data.select(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"),
                               F.min(y).alias("y0"), F.max(y).alias("y1"))).scalar()
    # degenerate extents are widened like a plotting library would (+-0.1 around the point)
    x0 = F.when(ext["x1"] == ext["x0"], ext["x0"] - 0.1).otherwise(ext["x0"])
    x1 = F.when(ext["x1"] == ext["x0"], ext["x1"] + 0.1).otherwise(ext["x1"])
    y0 = F.when(ext["y1"] == ext["y0"], ext["y0"] - 0.1).otherwise(ext["y0"])
    y1 = F.when(ext["y1"] == ext["y0"], ext["y1"] + 0.1).otherwise(ext["y1"])
    pad = F.lit(1e-9) * (x1 - x0)
    x0p, x1p = x0 - pad, x1 + pad
    sx = (x1p - x0p) / F.lit(float(nx))
    sy = (y1 - y0) / F.lit(float(ny))
    ix = (F.col(x) - x0p) / sx
    iy = (F.col(y) - y0) / sy
    pts = data.select(ix.alias("_ix"), iy.alias("_iy"), F.col(c).alias("_c"))
    ix1, iy1 = F.bround(F.col("_ix")), F.bround(F.col("_iy"))
    ix2, iy2 = F.floor(F.col("_ix")), F.floor(F.col("_iy"))
    d1 = F.pow(F.col("_ix") - ix1, 2) + 3.0 * F.pow(F.col("_iy") - iy1, 2)
    d2 = F.pow(F.col("_ix") - ix2 - 0.5, 2) + 3.0 * F.pow(F.col("_iy") - iy2 - 0.5, 2)
    first = d1 < d2
    cells = pts.select(
        F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("lattice"),
        F.when(first, ix1).otherwise(ix2).cast("int").alias("i"),
        F.when(first, iy1).otherwise(iy2).cast("int").alias("j"),
        "_c")
    agg = cells.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.avg("_c").alias("mean_value"))
    off = F.when(F.col("lattice") == 2, F.lit(0.5)).otherwise(F.lit(0.0))
    return agg.select("lattice", "i", "j",
                      (x0p + (F.col("i") + off) * sx).alias("center_x"),
                      (y0 + (F.col("j") + off) * sy).alias("center_y"),
                      "n", "mean_value")
