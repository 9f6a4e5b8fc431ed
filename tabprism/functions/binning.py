"""Bin assignment as plain column expressions (stay inside whole-stage codegen).

``right_closed_bin`` reproduces ``pandas.cut`` defaults: bins ``(lo, hi]``, the
lowest edge excluded, values outside every bin -> NULL. ``left_closed_position``
is the ``[lo, hi)`` lookup used to place a statistic on the bin axis, falling back
to the last bin when nothing matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class BinSpec:
    edges: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self):
        if len(self.edges) != len(self.labels) + 1:
            raise ValueError("need one more edge than labels")

    def intervals(self):
        for i, (lo, hi) in enumerate(zip(self.edges[:-1], self.edges[1:])):
            yield i + 1, self.labels[i], lo, hi


INF = float("inf")

# Bin edges and labels of the reference's profiling charts.
PRICE_BINS_8 = BinSpec((0, 50, 100, 150, 200, 300, 500, 1000, INF),
                       ("<$50", "$50-100", "$100-150", "$150-200",
                        "$200-300", "$300-500", "$500-1k", ">$1k"))
PRICE_BINS_7 = BinSpec((0, 50, 100, 150, 200, 300, 500, INF),
                       ("<$50", "$50-100", "$100-150", "$150-200",
                        "$200-300", "$300-500", ">$500"))
TENURE_BINS = BinSpec((0, 1, 2, 3, 5, 8, 12, 20),
                      ("<1yr", "1-2yr", "2-3yr", "3-5yr", "5-8yr", "8-12yr", "12+yr"))
AMENITY_BINS = BinSpec((0, 5, 10, 15, 20, 30, 50, 100),
                       ("1-5", "6-10", "11-15", "16-20", "21-30", "31-50", "50+"))


def right_closed_bin(c: Column, spec: BinSpec) -> Column:
    """1-based ordinal of the ``(lo, hi]`` bin holding ``c``; NULL when none."""
    expr = None
    for ordinal, _, lo, hi in spec.intervals():
        cond = c > F.lit(float(lo))
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(float(hi)))
        expr = F.when(cond, F.lit(ordinal)) if expr is None else expr.when(cond, F.lit(ordinal))
    return expr


def left_closed_position(c: Column, spec: BinSpec) -> Column:
    """0-based index i with ``lo_i <= c < hi_i``; the last index when none matches."""
    expr = None
    for ordinal, _, lo, hi in spec.intervals():
        cond = (c >= F.lit(float(lo))) & (c < F.lit(float(hi)))
        expr = F.when(cond, F.lit(ordinal - 1)) if expr is None else expr.when(cond, F.lit(ordinal - 1))
    return expr.otherwise(F.lit(len(spec.labels) - 1))


_BIN_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("lo", T.DoubleType(), False),
    T.StructField("hi", T.DoubleType(), False),
])


def bin_table(spark: SparkSession, spec: BinSpec) -> DataFrame:
    """The label domain of a bin spec as a tiny DataFrame (fixed size)."""
    rows = [(o, lab, float(lo), float(hi)) for o, lab, lo, hi in spec.intervals()]
    return spark.createDataFrame(rows, _BIN_SCHEMA)


def case_sql_right_closed(col: str, spec: BinSpec) -> str:
    """The same right-closed chain as SQL text (for the DuckDB oracle)."""
    parts = []
    for ordinal, _, lo, hi in spec.intervals():
        cond = f"{col} > {float(lo)!r}"
        if not math.isinf(hi):
            cond += f" AND {col} <= {float(hi)!r}"
        parts.append(f"WHEN {cond} THEN {ordinal}")
    return "CASE " + " ".join(parts) + " END"


def case_sql_left_closed(col: str, spec: BinSpec) -> str:
    parts = []
    for ordinal, _, lo, hi in spec.intervals():
        hi_txt = "'Infinity'::DOUBLE" if math.isinf(hi) else repr(float(hi))
        parts.append(f"WHEN {col} >= {float(lo)!r} AND {col} < {hi_txt} THEN {ordinal - 1}")
    return "CASE " + " ".join(parts) + f" ELSE {len(spec.labels) - 1} END"


def values_sql(spec: BinSpec) -> str:
    """``(VALUES ...)`` body with columns ord, label, lo, hi for the oracle."""
    rows = []
    for o, lab, lo, hi in spec.intervals():
        hi_txt = "'Infinity'::DOUBLE" if math.isinf(hi) else f"CAST({float(hi)!r} AS DOUBLE)"
        rows.append(f"({o}, '{lab}', CAST({float(lo)!r} AS DOUBLE), {hi_txt})")
    return "VALUES " + ", ".join(rows)
