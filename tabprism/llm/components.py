"""Connected components of an edge table by alternating star contraction.

Each round hangs the larger neighbours of every node on its smallest neighbour, then
does the same for the smaller ones. Rounds grow with the logarithm of the node count.
All work is aggregation and equi-joins; nothing but two sums per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import checkpoint


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    joined = both.join(low, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = low.select("u", F.col("m").alias("v"))
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own)
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge and is not its own root; root is the
    smallest node of the component. Null ends and loops are ignored; repeated edges and
    an empty table are fine."""
    x, y = F.col(a), F.col(b)
    now = checkpoint(edges.where(x.isNotNull() & y.isNotNull() & (x != y))
                     .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    state = _state(now)
    while state[0]:
        now = checkpoint(_stars(_stars(now, True), False))
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
