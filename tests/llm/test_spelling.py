import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import SF
from tabprism.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows, damage=199, min_chars=6, min_count=5):
    found = Counter()
    for doc, text in rows:
        for w in RUN.findall((text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if damage and h % damage == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    holes = defaultdict(set)  # words by what is left without one place, and as they are
    for w in counts:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    close = {w: {x for h in [w, *(w[:i] + w[i + 1:] for i in range(len(w)))] for x in holes[h] if one_edit(w, x)} for w in counts}
    form = {}
    for w, own in close.items():
        best = min(own, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(close[w]), counts[form[w]] if w in form else None)
    return out


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def drawn_words(draw, n, letters, low=6, high=12):
    words = {}
    while len(words) < n:
        w = "".join(draw.choice(letters) for _ in range(draw.randrange(low, high)))
        words[w] = draw.choice([5, 6, 9, 30, 200, 1200])
        for _ in range(3):
            i, x = draw.randrange(len(w)), list(w)
            edit = draw.randrange(3)
            x[i:i + 1] = [] if edit == 0 else [draw.choice(letters)] if edit == 1 else [x[i], draw.choice(letters)]
            if len(x) >= 6:
                words.setdefault("".join(x), draw.choice([5, 6, 9, 30]))
    return words


@pytest.mark.parametrize("hot", [3, spelling.HOT])
def test_variants_equal_brute_force(spark, hot):
    draw = random.Random(3)
    for letters, n in (("ab", 120), ("abcé", 300), ("etaoinshrdlu", 400)):
        counts = drawn_words(draw, n, letters)
        df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
        assert got(spelling.variants(df, hot_words=hot)) == brute_variants(counts)


def test_large_tiles_are_cut_and_blocked(spark):
    draw = random.Random(5)
    counts = {"stemword" + a + b + c: draw.choice([5, 40, 300]) for a in "abcdefgh" for b in "ijklmnopq" for c in "rstuvwxyz"}
    counts |= {"stemword" + a + b: 7 for a in "abcdefgh" for b in "ijklmnopq"}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    keys = spelling.tile_keys(df)
    largest = keys.groupBy(spelling.KEY).count().agg({"count": "max"}).first()[0]
    assert largest > spelling.BLOCK
    cut = spelling.cut_hot(keys, 100).groupBy(spelling.KEY).count().agg({"count": "max"}).first()[0]
    assert cut <= 100
    want = brute_variants(counts)
    assert got(spelling.variants(df)) == want
    assert got(spelling.variants(df, hot_words=100)) == want


def test_common_ends():
    a = np.array([[[1, 2, 3, 0], [1, 2, 0, 0]]], dtype=np.uint8)
    b = np.array([[[1, 2, 3, 4], [2, 2, 0, 0], [1, 2, 0, 0]]], dtype=np.uint8)
    assert spelling.common_ends(a, b).tolist() == [[[3, 0, 2], [2, 0, 2]]]


def test_roots_follow_long_ways(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("x", "w00"), ("y", "z")]
    rows = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert rows == {w: "w20" for w, _ in chain[:-1]} | {"y": "z"}


def test_nulls_case_letters_repeats_extra_columns_and_empty(spark):
    text = "Straßen Strassen strasen ÀÉÎabc àéîabc STRASSEN x×y÷zz 日本 letters " * 40
    rows = [(None, text, 1, "w"), (1, text, 1, "w"), (1, text, 2, "w"), (2, None, 2, None), (3, "", 0, None), (4, "Letterz " * 9 + "lettters-Lettersx " * 6, 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, word string")
    counts = brute_counts([(r[0], r[1]) for r in rows])
    assert counts["strassen"] > 100 and "ÀÉÎabc" in counts and "x×y÷zz" in counts
    assert got(spelling.spelling_groups(df, damage=199)) == brute_variants(counts)
    assert got(spelling.spelling_groups(df)) == brute_variants(brute_counts([(r[0], r[1]) for r in rows], damage=None))
    assert spelling.spelling_groups(df.limit(0), damage=199).collect() == []


def test_very_long_text(spark):
    draw = random.Random(8)
    rows = [(7, " ".join("".join(draw.choice("abcd") for _ in range(draw.randrange(4, 9))) for _ in range(150_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spelling.spelling_groups(df, damage=199)) == brute_variants(brute_counts(rows))


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute_variants(brute_counts(rows))
    assert got(queries.op11_spelling(spark, SF)) == want
    assert any(v[0] for v in want.values()) and any(v[3] for v in want.values())
