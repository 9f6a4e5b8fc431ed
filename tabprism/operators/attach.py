"""Joining a per-group statistic to the rows of the groups.

A join on a handful of group keys would deal all rows to as many tasks. The statistic has
one row per group, so it is materialised, counted and broadcast while it is small; then
the row side is not shuffled at all. Above the bound there are so many keys that an
ordinary equi-join spreads the rows, and adaptive execution splits the hot ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.session import cut_lineage

MAX_BROADCAST_GROUPS = 100_000


def attach(rows: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``stats`` (one row per group) on the columns ``by``."""
    stats = cut_lineage(stats)
    if stats.count() <= MAX_BROADCAST_GROUPS:
        stats = F.broadcast(stats)
    return rows.join(stats, list(by), how)
