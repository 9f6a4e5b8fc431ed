"""Sharding by longest-processing-time scheduling.

Groups that must stay together (by default: equal texts) are taken by size, largest
first, and each goes to the shard with the least load, kept in a heap. Loads depend on
the group sizes alone, so the driver walks the histogram of sizes, streamed from a
sorted table: all groups of one size are dealt in one step, whose outcome is that of as
many heap pops. The histogram has at most sqrt(2 x total bytes) rows and is never held
whole. Which of the equally large groups goes where follows from its position among
them, found by range partitions, so neither a common size nor a shard is one task.

Defined results: a null text has size 1 (no bytes, plus 1) and is a group apart from '';
repeated rows share their group's shard and have slots of their own; ids may be null
(first in slot order); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import checkpoint, positions, sha_key, shared_folder, text_bytes

SHARDS = 8
BLOCK = 50_000


def deal(heap: list[tuple[int, int]], size: int, count: int) -> list[int]:
    """Deal ``count`` groups of ``size`` to the least loaded shards; ties go to the lower
    shard. Changes the heap of (load, shard) and returns how many each shard got."""
    n = len(heap)
    got = [0] * n
    if count <= 2 * n:
        for _ in range(count):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            got[shard] += 1
        return got
    # One pop after the other takes the ``count`` smallest of load + i * size over all
    # shards and i = 0, 1, ...; find the last value taken.
    loads = dict((shard, load) for load, shard in heap)
    up_to = lambda v, load: (v - load) // size + 1 if v >= load else 0
    low, high = min(loads.values()), max(loads.values()) + size * count
    while low < high:
        mid = (low + high) // 2
        if sum(up_to(mid, x) for x in loads.values()) >= count:
            high = mid
        else:
            low = mid + 1
    left = count
    for shard, load in loads.items():
        got[shard] = up_to(low - 1, load)
        left -= got[shard]
    for shard in sorted(loads):
        if left and low >= loads[shard] and (low - loads[shard]) % size == 0:
            got[shard] += 1
            left -= 1
    heap[:] = [(loads[s] + got[s] * size, s) for s in loads]
    heapq.heapify(heap)
    return got


def _quotas(groups: DataFrame, shards: int) -> DataFrame:
    """(size, ends): the groups of this size at positions below ends[0] go to shard 0,
    below ends[1] to shard 1, and so on."""
    spark, path = groups.sparkSession, shared_folder(groups.sparkSession, "lpt-quotas")
    schema = "of_size long, ends array<long>"
    heap, block = [(0, s) for s in range(shards)], []

    def flush() -> None:
        spark.createDataFrame(block, schema).coalesce(1).write.mode("append").parquet(path)
        block.clear()

    sizes = groups.groupBy("group_size").count().orderBy(F.desc("group_size"))
    for row in sizes.toLocalIterator(prefetchPartitions=True):
        ends, total = [], 0
        for n in deal(heap, row["group_size"], row["count"]):
            total += n
            ends.append(total)
        block.append((row["group_size"], ends))
        if len(block) >= BLOCK:
            flush()
    flush()
    return spark.read.schema(schema).parquet(path)


def lpt_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """id, size, text_crc32, shard and slot (position within the shard) of every row."""
    rows = checkpoint(df.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_bytes(text_col)).alias("text_crc32"), sha_key(F.col(text_col)).alias("group"),
        F.monotonically_increasing_id().alias("seq")))
    groups = checkpoint(rows.groupBy("group").agg(F.sum("size").alias("group_size")))
    placed = positions(groups, ["group_size"], ["group"], "at").join(_quotas(groups, shards).hint("merge"), F.col("group_size") == F.col("of_size"))
    placed = placed.select(F.col("group").alias("of_group"), F.size(F.filter("ends", lambda e: e <= F.col("at"))).alias("shard"))
    dealt = rows.join(placed, F.col("group").eqNullSafe(F.col("of_group"))).select("id", "size", "text_crc32", "seq", "shard")
    return positions(dealt, ["shard"], ["id", "seq"], "slot").select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
