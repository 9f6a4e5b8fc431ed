"""Exact attributions of a linear model (section 2J) and the inverse normal CDF of the draws.

Linear contributions (exact SHAP of a linear model) are ``coef * (x - baseline)``: pure
column arithmetic on the long (row, feature) table. Explanations of any fitted model are
in :mod:`tabprism.operators.attribution`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



# ------------------------------------------------------------------ linear contributions
def linear_contributions(long_df: DataFrame, coefs: DataFrame, baseline: DataFrame,
                         key: str = "listing_id") -> DataFrame:
    """(key, feature, value, weight) with ``weight = coef * (x - baseline)``.

    ``coefs`` (feature, coef) and ``baseline`` (feature, base) have one row per
    feature (bounded by the model), so they are broadcast. NULL x -> baseline.
    """
    p = coefs.join(baseline, "feature")
    out = long_df.join(F.broadcast(p), "feature")
    x = F.coalesce(F.col("value"), F.col("base"))
    return out.select(key, "feature", x.alias("value"), (F.col("coef") * (x - F.col("base"))).alias("weight"))


def global_importance(contrib: DataFrame, k: int = 5) -> DataFrame:
    """Mean |weight| per feature, top k (ties by feature)."""
    imp = contrib.groupBy("feature").agg(F.avg(F.abs("weight")).alias("mean_abs"))
    top = imp.orderBy(F.desc("mean_abs"), "feature").limit(k)
    return top.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "feature")))


# ------------------------------------------------------------------ draws
# Coefficients of Acklam's rational approximation to the inverse normal CDF.
_PPF_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
          1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
_PPF_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
          6.680131188771972e+01, -1.328068155288572e+01]
_PPF_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
          -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
_PPF_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]


def _poly(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_ppf(u: Column) -> Column:
    """Inverse standard normal CDF as a JVM expression (relative error < 1.2e-9)."""
    p_low = 0.02425
    q_lo = F.sqrt(-2.0 * F.log(u))
    q_hi = F.sqrt(-2.0 * F.log(1.0 - u))
    q = u - 0.5
    r = q * q
    tail_lo = _poly(_PPF_C, q_lo) / (_poly(_PPF_D, q_lo) * q_lo + 1.0)
    tail_hi = -_poly(_PPF_C, q_hi) / (_poly(_PPF_D, q_hi) * q_hi + 1.0)
    central = _poly(_PPF_A, r) * q / (_poly(_PPF_B, r) * r + 1.0)
    return F.when(u < p_low, tail_lo).when(u > 1.0 - p_low, tail_hi).otherwise(central)
