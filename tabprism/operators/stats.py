"""Profiling aggregates (section 2D).

Every statistic is a partial+final aggregate (map-side combine) or uses the
distributed exact quantiles of :mod:`tabprism.operators.quantiles`. Nothing keeps
all rows of a group in one task, and no global ``over ()`` window runs on row-level
data: windows only ever see already-aggregated rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprism.operators.attach import attach
from tabprism.operators.quantiles import exact_quantiles
from tabprism.session import cut_lineage


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "feature",
            value: str = "value") -> DataFrame:
    """Unpivot ``cols`` to (ids..., name, value); NULL values are dropped."""
    out = df.unpivot(list(ids), list(cols), name, value)
    return out.where(F.col(value).isNotNull())


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column (long form)."""
    lng = to_long(df.select(*cols), [], cols).select("feature", F.col("value").cast("double").alias("value"))
    basic = lng.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(lng, "value", [0.25, 0.5, 0.75], ["feature"], ["p25", "p50", "p75"]).drop("n")
    return basic.join(qs, "feature").select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def distribution_stats(df: DataFrame, value: str) -> DataFrame:
    """Mean, median, sample std, mean -/+ 1 std, population skew, excess kurtosis, n."""
    data = df.select(value).where(F.col(value).isNotNull())
    m = data.agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                 F.stddev_samp(value).alias("std"), F.skewness(value).alias("skew"),
                 F.kurtosis(value).alias("kurt"))
    med = exact_quantiles(data, value, [0.5], names=["median"]).select("median").scalar()
    return m.withColumn("median", med).select("n", "mean", "median", "std", (F.col("mean") - F.col("std")).alias("minus_1sd"),
                    (F.col("mean") + F.col("std")).alias("plus_1sd"), "skew", "kurt")


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for the strict lower triangle, one aggregate."""
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_r{k}")
            for k, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"_r{k}").alias("r"))
                     for k, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows))


def missing_fraction(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of NULL (or NaN) values per column, only those above 0, descending."""
    cols = list(cols or df.columns)

    def miss(c: str) -> Column:
        isnull = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            isnull = isnull | F.isnan(F.col(c))
        return F.avg(isnull.cast("double"))

    wide = df.agg(*[miss(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing_frac"))
                     for i, c in enumerate(cols)])
    return wide.select(F.inline(rows)).where(F.col("missing_frac") > 0).orderBy(F.desc("missing_frac"), "column_name")


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, Tukey whiskers (farthest point within 1.5 IQR), outliers.

    Quartiles per group come from the distributed exact quantiles; the whiskers are
    a second aggregate after joining the per-group fences back on the group key.
    """
    by = list(by)
    data = df.select(*by, value).where(F.col(value).isNotNull())
    for b in by:
        data = data.where(F.col(b).isNotNull())
    q = cut_lineage(exact_quantiles(data, value, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"]))  # two readers
    fences = q.select(*by, "n", "q1", "median", "q3",
                      (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_lo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_hi"))
    v = F.col(value)
    agg = attach(data, fences.select(*by, "_lo", "_hi"), by).groupBy(*by).agg(
        F.min(F.when(v >= F.col("_lo"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("_hi"), v)).alias("whisker_hi"),
        F.count(F.when((v < F.col("_lo")) | (v > F.col("_hi")), v)).alias("n_outliers"))
    return fences.drop("_lo", "_hi").join(agg, by).select(
        *by, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers")


def group_mean(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Mean of ``cols`` per group after dropping rows with NULLs in them."""
    data = df.select(by, *cols).dropna()
    return data.groupBy(by).agg(*[F.avg(c).alias(f"{c}_mean") for c in cols])


MAX_PIVOT_COLUMNS = 1000


def pivot_mean(df: DataFrame, row: str, col: str, value: str, prefix: str) -> DataFrame:
    """Mean of ``value`` per row x col, pivoted wide with prefixed column names
    (prefixing avoids a case-insensitive clash between keys and values), plus a flag
    for the row holding the global maximum cell (within 1e-6). The columns are the values
    of ``col`` in the data, sorted; more than ``MAX_PIVOT_COLUMNS`` raise an error."""
    data = df.select(row, col, value).where(F.col(row).isNotNull() & F.col(col).isNotNull())
    values = [r[0] for r in data.select(col).distinct().limit(MAX_PIVOT_COLUMNS + 1).collect()]
    if len(values) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"{col} has more than {MAX_PIVOT_COLUMNS} values; aggregate in long form instead")
    values.sort()
    wide = (data.groupBy(row).pivot(col, list(values)).agg(F.avg(value)))
    wide = wide.select(row, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])
    cells = [F.col(f"{prefix}{v}") for v in values]
    gmax = data.groupBy(row, col).agg(F.avg(value).alias("_m")).select(F.max("_m")).scalar()
    has_max = F.greatest(*[F.coalesce(F.abs(c - gmax) < 1e-6, F.lit(False)) for c in cells])
    return wide.withColumn("has_global_max", has_max)


def kde(df: DataFrame, value: str, points: int = 500, by: Sequence[str] = (), min_n: int = 0,
        cut: float = 0.0, tail_sd: float = 9.0) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth (sample std x n^(-1/5)) on an evenly
    spaced grid of ``points`` from min - cut*bw to max + cut*bw.

    Rows are first collapsed to distinct (value, count). Each distinct value then
    contributes only to the grid points within ``tail_sd`` bandwidths (beyond that the
    kernel is below 3e-18 of its peak), so the work is a bounded fan-out per value,
    never rows x grid. Groups with n <= ``min_n`` are skipped.
    """
    by = list(by)
    data = df.select(*by, value).where(F.col(value).isNotNull())
    for b in by:
        data = data.where(F.col(b).isNotNull())
    grouped = bool(by)
    st = data.groupBy(*by).agg(F.count(value).alias("_n"), F.stddev_samp(value).alias("_sd"),
                               F.min(value).alias("_min"), F.max(value).alias("_max"))
    st = st.where((F.col("_n") > min_n) & (F.col("_sd") > 0))
    bw = F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    st = (st.withColumn("_bw", bw)
          .withColumn("_g0", F.col("_min") - cut * F.col("_bw"))
          .withColumn("_g1", F.col("_max") + cut * F.col("_bw"))
          .withColumn("_step", (F.col("_g1") - F.col("_g0")) / F.lit(float(points - 1)))
          .select(*by, "_n", "_bw", "_g0", "_step"))
    vc = data.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    if grouped:
        # per-group bandwidths: one row per group, joined on the group key
        vc = attach(vc, st, by)
        grid = st.select(*by, "_g0", "_step", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    else:
        # one global group: its parameters are a scalar subquery, no join at all
        g = st.select(F.struct("_n", "_bw", "_g0", "_step")).scalar()
        vc = vc.select(value, "_c", *[g[c].alias(c) for c in ("_n", "_bw", "_g0", "_step")])
        grid = (vc.sparkSession.range(points).select(F.col("id").cast("int").alias("i"))
                .select("i", g["_g0"].alias("_g0"), g["_step"].alias("_step")).where(F.col("_g0").isNotNull()))
    v = F.col(value)
    lo_i = F.greatest(F.lit(0), F.ceil((v - tail_sd * F.col("_bw") - F.col("_g0")) / F.col("_step")))
    hi_i = F.least(F.lit(points - 1), F.floor((v + tail_sd * F.col("_bw") - F.col("_g0")) / F.col("_step")))
    fan = vc.where(lo_i <= hi_i).select(
        *by, v.alias("_v"), "_c", "_n", "_bw", "_g0", "_step",
        F.explode(F.sequence(lo_i.cast("int"), hi_i.cast("int"))).alias("i"))
    x = F.col("_g0") + F.col("i") * F.col("_step")
    z = (x - F.col("_v")) / F.col("_bw")
    contrib = F.col("_c") * F.exp(-0.5 * z * z) / (F.col("_n") * F.col("_bw") * F.lit(math.sqrt(2 * math.pi)))
    dens = fan.groupBy(*by, "i").agg(F.sum(contrib).alias("density"))
    out = grid.join(dens, [*by, "i"], "left")
    return out.select(*by, "i", (F.col("_g0") + F.col("i") * F.col("_step")).alias("x"),
                      F.coalesce(F.col("density"), F.lit(0.0)).alias("density"))


def peak(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The key with the highest value (lowest ``order`` on ties)."""
    return df.agg(F.max_by(F.struct(F.col(key), F.col(value)),
                           F.struct(F.col(value), -F.col(order))).alias("_p")) \
             .select(F.col("_p")[key].alias(key), F.col("_p")[value].alias(value))


def mode_by_ordinal(counts: DataFrame, ordinal: str = "ord", n: str = "n",
                    by: Sequence[str] = ()) -> DataFrame:
    """Most frequent bucket; ties go to the lowest ordinal."""
    best = F.min_by(F.col(ordinal), F.struct(-F.col(n), F.col(ordinal)))
    return counts.where(F.col(n) > 0).groupBy(*by).agg(best.alias(ordinal))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares slope and intercept of y on x (x NULL -> 0)."""
    xc = F.coalesce(F.col(x).cast("double"), F.lit(0.0))
    return df.agg(F.regr_slope(F.col(y), xc).alias("slope"), F.regr_intercept(F.col(y), xc).alias("intercept"))
