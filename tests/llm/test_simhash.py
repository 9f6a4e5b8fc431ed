import random
from itertools import combinations

import numpy as np
import xxhash

from tabprism.llm import simhash
from tabprism.llm.components import components


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=2):
    up = {p: p for p in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in combinations(sorted(up), 2):
        if bin(a ^ b).count("1") <= radius:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {p: find(p) for p in up}


def test_fingerprint_matches_definition():
    for text in ("", " \t\n", "One", "two Words", "a b c", "É b\xa0c d\x0be f", "x " * 50, "Der Äpfel MIT   leer"):
        assert simhash.fingerprint(text.encode()) == brute_print(text)


def test_buckets_find_all_links_within_radius():
    rng = random.Random(5)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(rng.randint(1, 12))]
    prints = sorted(set(prints + [0, 2**64 - 1, 3, 5]))
    label = np.arange(len(prints))
    arr = np.array(prints, dtype="<u8")
    for cut_at in (4096, 8):
        simhash.LARGE_BUCKET = cut_at
        got = simhash.link_buckets(np.zeros(len(arr), dtype=np.int64), np.arange(len(arr)), arr, label.copy())
        want = brute_components(prints)
        assert [prints[i] for i in got] == [want[p] for p in prints]
    simhash.LARGE_BUCKET = 4096


def test_near_dups_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40, 400]))]
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            if rng.random() < .6:
                own[rng.randrange(len(own))] = "changed"
            rows.append((n * 7 % 1001, " ".join(own), "x"))
            n += 1
    rows += [(5000, None, "x"), (5001, "", "y"), (5002, " \n", None), (None, "alone here now", "z"), (7, "w1", "x"), (7, "w1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.simhash_near_dups(df)
    prints = [brute_print(t) for _, t, _ in rows]
    root = brute_components(prints)
    low = {}
    for (d, _, _), p in zip(rows, prints):
        if d is not None:
            low[root[p]] = min(low.get(root[p], d), d)
    want = sorted((str(d), f"{p:016x}", str(low.get(root[p]))) for (d, _, _), p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == want
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(root.values()))


def test_empty_and_null_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_near_dups(empty).count() == 0
    assert simhash.keep_first(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "a b c d")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.simhash_near_dups(nulls).collect()} == {(None, None)}


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_survivor_does_not_depend_on_partitions(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, c, float(k)) for k, c in enumerate("zyxwvutsrq")] + [(1, text, "z", 0.0)] + [(2, text, "a", 0.0), (None, text, "b", 1.0)]
    found = set()
    for parts in (1, 3, 11):
        for order in (rows, rows[::-1]):
            df = spark.createDataFrame(order, "doc_id long, text string, source string, h1 double").repartition(parts)
            out = simhash.keep_first(df)
            assert out.columns == df.columns
            found.add(tuple(map(tuple, out.collect())))
    assert len(found) == 1 and len(found.pop()) == 1


def test_crowded_buckets_are_dealt_again_before_the_shuffle(spark):
    rng = random.Random(11)
    base = rng.getrandbits(64)
    # most fingerprints share two whole blocks, so one bucket holds them all
    crowd = {base ^ (rng.getrandbits(32) << 32) for _ in range(1500)}
    crowd |= {p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in rng.sample(sorted(crowd), 400)}
    crowd |= {rng.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1}
    prints = sorted(crowd)
    table = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long").repartition(4)
    plain, split = simhash.bucketed(table), simhash.bucketed(table, hot=50)
    most = [d.groupBy("t", "k", "s").count().agg({"count": "max"}).first()[0] for d in (plain, split)]
    assert most[0] > 1400 and most[1] < 50
    want = brute_components(prints)
    for hot in (50, 10**9):
        got = {r.node % 2**64: r.root % 2**64 for r in components(simhash.links(table, hot=hot), "a", "b").collect()}
        group = {}
        for p in prints:
            group.setdefault(got.get(p, p), set()).add(p)
        brute = {}
        for p in prints:
            brute.setdefault(want[p], set()).add(p)
        assert sorted(map(sorted, group.values())) == sorted(map(sorted, brute.values()))


def test_parts_of_the_other_bits_cover_them_once():
    for radius in (1, 2, 3):
        blocks = simhash._blocks(radius)
        for used in combinations(range(len(blocks)), 2):
            bits = [at + x for part in simhash._rest_parts(blocks, used, radius) for at, n in part for x in range(n)]
            taken = [blocks[i][0] + x for i in used for x in range(blocks[i][1])]
            assert sorted(bits + taken) == list(range(64))
