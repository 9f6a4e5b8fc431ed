import math
import random
from collections import Counter

from tabprism.llm import decontaminate as D
from tests.llm.helpers import SF


def brute(docs, items):
    """Exhaustive scoring of every window of every item."""
    own = [(i, t, D.words_of(t)) for i, t in items if D.words_of(t)]
    df = Counter(w for _, _, ws in own for w in set(ws))
    mean = sum(len(ws) for _, _, ws in own) / len(own)
    impact = []
    for _, _, ws in own:
        tf = Counter(ws)
        impact.append({w: math.log(1 + (len(own) - df[w] + .5) / (df[w] + .5)) * n * 2.2 / (n + 1.2 * (.25 + .75 * len(ws) / mean)) for w, n in tf.items()})
    out = []
    for d, text in docs:
        ws = D.words_of(text)
        here = set(ws)
        for k, (i, t, item) in enumerate(own):
            total, best = sum(impact[k].values()), None
            if sum(x for w, x in impact[k].items() if w in here) < .7 * total - 1e-9:
                continue
            for at in range(0, max(len(ws), 1), len(item)):
                held = ws[at:at + 2 * len(item)]
                score = sum(impact[k].get(w, 0) for w in set(held)) / total
                if score >= .7 - 1e-9 and (len(item) >= 6 or D.in_a_row(item, held)):
                    q, a = (D.overlap(part, held) for part in D.question_and_answer(t))
                    if min(q, a) >= .5:
                        best = max(best or (0,), (round(score, 6), round(q, 6), round(a, 6)))
            if best:
                out.append((str(d), str(i), *best))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), str(r.item_id), r.score, r.question_share, r.answer_share) for r in df.collect())


def fixture():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.randint(4, 40)).capitalize() + ("? " + say(5) if i % 3 else ".")) for i in range(150)]
    items += [(150, None), (151, ""), (152, "?!"), (153, "one"), (None, items[4][1]), (7, items[5][1])]
    docs = []
    for d in range(60):
        parts = [say(rng.randint(0, 150))]
        if d % 3 == 0:
            words = items[rng.randrange(100)][1].split()
            for _ in range(rng.choice([0, 1, len(words) // 5, len(words) // 2])):
                words[rng.randrange(len(words))] = "changed"
            parts += [" ".join(words).upper() if d % 2 else "\n".join(words), say(90)]
        docs.append((d, " ".join(parts)))
    return docs + [(None, items[8][1]), (5, items[9][1]), (5, items[9][1]), (900, None), (901, ""), (902, say(20_000) + items[11][1])], items


def test_sorted_and_dense_sums_agree(monkeypatch):
    docs, items = fixture()
    own = [(n, i, t) for n, (i, t) in enumerate(items) if D.words_of(t)]
    df = Counter(w for _, _, t in own for w in set(D.words_of(t)))
    posted = [(n, w, c, df[w]) for n, _, t in own for w, c in Counter(D.words_of(t)).items()]
    index = D.ItemIndex(own, posted, (len(own), 20.0))
    dense = [index.hits(D.words_of(t)) for _, t in docs]
    monkeypatch.setattr(D, "DENSE", 0)
    assert dense == [index.hits(D.words_of(t)) for _, t in docs] and any(dense)


def test_against_exhaustive_scoring(spark):
    docs, items = fixture()
    d = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 10
    assert rows(D.contaminated(d, b)) == want
    assert rows(D.contaminated(d, b, group_bytes=2000)) == want
    clean = D.without_leaks(d, b)
    assert clean.columns == d.columns
    leaking = {int(n) for n, *_ in brute([(n, t) for n, (_, t) in enumerate(docs)], items)}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for n, (i, _) in enumerate(docs) if n not in leaking)


def test_every_planted_passage_is_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    assert got >= {(d, r.item_id) for r in items.collect() for d, t in texts.items() if r.text in t}
    assert brute(sorted(texts.items()), [(r.item_id, r.text) for r in items.collect()]) == rows(D.contaminated(docs, items))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0
    assert D.without_leaks(docs, items.limit(0)).count() == 1
    assert D.contaminated(docs, items).count() == 1


def test_scattered_words_of_short_items_stay(spark):
    items = spark.createDataFrame([(1, "blue whale"), (2, "Who sings? nobody"), (3, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    rows = [(1, "a whale swims in the blue sea"), (2, "the Blue Whale swims"), (3, "nobody here knows who sings"), (4, "who sings nobody"), (5, "plain text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()) == [(2, 1), (4, 2)]
    assert sorted(r.doc_id for r in D.without_leaks(docs, items).collect()) == [1, 3, 5]


def test_a_long_item_changes_no_other_verdict(spark):
    rng = random.Random(12)
    vocab = [f"v{i}" for i in range(3000)]
    item = [rng.choice(vocab) for _ in range(17)]
    spread = [rng.choice(vocab) for _ in range(2400)]
    for i in range(0, 15, 3):  # its trigrams far apart
        spread[150 * i:150 * i + 3] = item[i:i + 3]
    long = " ".join(rng.choice(vocab) for _ in range(4000))
    docs = spark.createDataFrame([(1, " ".join(spread)), (2, "before " * 40 + " ".join(item) + " after" * 40), (3, "x " * 70 + long)], "doc_id long, text string")
    short = [(1, " ".join(item)), (2, "who wrote the tale of a grey cat and a red fox? somebody else did")]
    few = spark.createDataFrame(short, "item_id long, text string")
    many = spark.createDataFrame([*short, (3, long)], "item_id long, text string")
    pairs = lambda items: {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    assert pairs(few) == {(2, 1)}
    assert pairs(many) == {(2, 1), (3, 3)}


def test_item_ids_of_any_type(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(1, "say who sings the blue song at noon? nobody sings it at noon here")], "doc_id int, text string")
    items = spark.createDataFrame([(7, "who sings the blue song at noon? nobody sings it at noon"), (None, "other words altogether are here now")], "item_id int, text string")
    for kind in ("tinyint", "smallint", "int", "bigint", "string", "double", "decimal(12,2)", "date"):
        own = F.col("item_id").cast(kind) if kind != "date" else F.date_add(F.lit("2020-01-01"), F.col("item_id"))
        out = D.contaminated(docs, items.withColumn("item_id", own))
        assert out.schema["item_id"].dataType.simpleString() == kind
        assert out.count() == 1 and out.first().item_id is not None
