"""Exact, distributed order statistics.

Spark's ``percentile`` keeps a value->count map per group and merges it in one task,
so a global median over a continuous column (or over one hot group holding a third
of the rows) would pull every distinct value into a single task. Here the ranks are
computed with bounded per-task state instead:

1. pre-aggregate to distinct ``(group, value, count)`` (map-side combine);
2. deal the distinct values by ranges of (group, value), so a large group is split over
   as many tasks as its size asks for, at a cost per row that does not depend on the
   number of partitions;
3. per ``(group, range)`` total counts (a tiny table) give each range's offset;
4. a window per ``(group, range)`` gives the count of strictly smaller values;
5. the rows whose rank interval covers a target rank are picked and interpolated
   exactly like ``percentile`` / ``quantile_cont`` (linear, position q*(n-1)).

The value of every statistic is exact, whatever the number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprism.session import cut_lineage


def ranked_counts(df: DataFrame, value: str, by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Distinct values per group with ``_cnt`` and ``_before`` (rows strictly below).

    Also returns ``_n`` (group size). NULL values and NULL group keys are dropped.
    """
    by = list(by)
    cond = F.col(value).isNotNull()
    for b in by:
        cond = cond & F.col(b).isNotNull()
    base = df.select(*by, value).where(cond)
    vc = base.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_cnt"))
    parts = [buckets] if buckets is not None else []
    # Read twice below: the cut into ranges must be the same for both readers.
    vc = cut_lineage(vc.repartitionByRange(*parts, *by, value).withColumn("_rng", F.spark_partition_id()))
    totals = vc.groupBy(*by, "_rng").agg(F.sum("_cnt").alias("_rtot"))
    w_off = Window.partitionBy(*by).orderBy("_rng")
    totals = (totals
              .withColumn("_off", F.sum("_rtot").over(
                  w_off.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("_n", F.sum("_rtot").over(
                  w_off.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
              .select(*by, "_rng", F.coalesce("_off", F.lit(0)).alias("_off"), "_n"))
    w_in = Window.partitionBy(*by, "_rng").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    vc = vc.withColumn("_before_in", F.coalesce(F.sum("_cnt").over(w_in), F.lit(0)))
    out = vc.join(totals, [*by, "_rng"])
    return out.select(*by, value, "_cnt", (F.col("_off") + F.col("_before_in")).alias("_before"), "_n")


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """One row per group: ``by`` columns, ``n`` and one column per quantile.

    Same result as ``percentile(value, q)`` (linear interpolation at position
    q * (n - 1)), computed with bounded per-task state (see module docstring). Every
    distinct-value row knows its group size, so the target ranks are evaluated per row:
    only rows whose rank interval [before, before + count) covers a target survive,
    and one grouped aggregate picks the lower / upper neighbours of each target.
    """
    by = list(by)
    names = list(names) if names else [f"q{int(round(q * 100)):02d}" for q in qs]
    rc = ranked_counts(df, value, by, buckets)
    before, cnt, v = F.col("_before"), F.col("_cnt"), F.col(value)

    def covers(k):
        return (before <= k) & (k < before + cnt)

    keep, aggs, outs = None, [], []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        lo_k, hi_k = F.floor(pos), F.ceil(pos)
        hit = covers(lo_k) | covers(hi_k)
        keep = hit if keep is None else keep | hit
        # exactly one distinct value covers each rank of a group
        aggs += [F.max(F.when(covers(lo_k), v)).alias(f"_lo{i}"), F.max(F.when(covers(hi_k), v)).alias(f"_hi{i}")]
        frac = pos - F.floor(pos)
        outs.append((F.col(f"_lo{i}") + frac * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(names[i]))
    agg = rc.where(keep).groupBy(*by, "_n").agg(*aggs)
    return agg.select(*by, F.col("_n").alias("n"), *outs)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by, [name]).drop("n")
