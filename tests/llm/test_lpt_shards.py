import heapq
import random
import zlib
from collections import Counter, defaultdict

from tabprism.llm import lpt_shards, queries
from tests.llm.helpers import SF


def naive(sizes, n):
    heap, loads = [(0, s) for s in range(n)], [0] * n
    for size in sorted(sizes, reverse=True):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        loads[shard] += size
    return loads


def test_deal_is_as_many_heap_pops():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 9)
        start = [(rng.randrange(60), s) for s in range(n)]
        size, count = rng.randint(1, 9), rng.randint(0, 90)
        heap = sorted(start)
        want = [0] * n
        for _ in range(count):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            want[shard] += 1
        mine = sorted(start)
        assert lpt_shards.deal(mine, size, count) == want
        assert sorted(mine) == sorted(heap)


def check(rows, texts, n):
    size = lambda t: len((t or "").encode()) + 1
    groups = Counter()
    for t in texts:
        groups[t] += size(t)
    loads, shards, slots = [0] * n, defaultdict(set), defaultdict(list)
    for r, t in rows:
        assert r.size == size(t) and r.text_crc32 == zlib.crc32((t or "").encode())
        loads[r.shard] += r.size
        shards[t].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert loads == naive(groups.values(), n)


def test_against_naive_heap(spark):
    rng = random.Random(4)
    texts = ["copy of many"] * 300 + ["é" * rng.choice([3, 5, 7]) + str(i % 170) for i in range(400)] + [None, None, "", "x" * 90_000]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, shard int, `group` int")
    got = lpt_shards.lpt_shards(df).collect()
    assert len(got) == len(texts)
    check([(r, texts[r.doc_id]) for r in got], texts, 8)


def test_null_and_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (3, "b")], "doc_id long, text string")
    got = lpt_shards.lpt_shards(df, shards=2).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert lpt_shards.lpt_shards(df.limit(0)).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_lpt_shards(spark, SF).collect()
    check([(r, docs[r.doc_id]) for r in got], list(docs.values()), 8)
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
