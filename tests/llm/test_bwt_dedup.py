import hashlib
import random

import numpy as np

from tabprism.llm import bwt_dedup, queries
from tests.llm.helpers import SF


def brute(docs, width=100):
    """docs: (order key, text bytes); removed runs and kept bytes per document."""
    seen, out = set(), []
    for key, text in sorted(docs):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - width + 1):
            w = text[i:i + width]
            if w in seen:
                gone[i:i + width] = True
            seen.add(w)
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and bool(gone[0])))
        out.append((key, len(text), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(text, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def fixture():
    rng = random.Random(6)
    say = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    common, docs = [say(n) for n in (99, 100, 101, 150, 400, 2000)], []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            c = rng.choice(common)
            if rng.random() < .4:
                at = rng.randrange(len(c))
                c = c[:at] + rng.choice("xyz") + c[at + rng.randint(0, 1):]
            parts += [say(rng.choice([0, 1, 30, 300])), c[:rng.randint(60, len(c))] if rng.random() < .3 else c]
        docs.append("".join(parts))
    docs += docs[:6] + ["a" * 5000, "ab" * 3000, "a" * 99, "a" * 100, "a" * 101, "", "b" * 9000 + "a" * 300, ("0123456789" * 30 + "x") * 40, common[5] * 3]
    return docs


def test_against_brute_force(spark):
    texts = fixture()
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = [(i * 3 - 40, t) for i, t in zip(ids, texts)] + [(9999, None)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, spans int").repartition(5)
    got = sorted((r.doc_id, r.n_bytes, sum(r.spans[1::2]) - sum(r.spans[::2]), len(r.spans) // 2, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in bwt_dedup.remove_repeats(df).collect())
    assert got == brute([(i, (t or "").encode()) for i, t in rows])


def test_small_limits_change_nothing(spark, monkeypatch):
    texts = fixture()
    want = brute([(i, t.encode()) for i, t in enumerate(texts)])
    for name, value in (("PIECE", 50), ("SEGMENT", 700)):
        monkeypatch.setattr(bwt_dedup, name, value)
        rows = [r for at in range(0, len(texts), 9) for r in bwt_dedup._batch_rows([(i, 1, t.encode()) for i, t in enumerate(texts)][at:at + 9], 3, 100)]
        ranges = [p for _, kind, p in rows if kind]
        for b in range(3):
            blobs = [p for bucket, kind, p in rows if bucket == b and not kind]
            ranges += [p for _, p in bwt_dedup._pack_ranges(*bwt_dedup.bucket_ranges(blobs))]
        for key, _, n_removed, n_spans, _ in want:
            own = [np.frombuffer(p[16:], "<i8").reshape(2, -1) for p in ranges if np.frombuffer(p[:8], "<i8")[0] == key]
            start, end = bwt_dedup.union_ranges(*np.concatenate(own, axis=1)) if own else (np.empty(0), np.empty(0))
            assert (int((end - start).sum()), len(start)) == (n_removed, n_spans)


def test_null_and_repeated_ids_and_empty(spark):
    t, u = "some text " * 30, "other words here " * 20
    df = spark.createDataFrame([(None, t), (3, t), (3, t), (4, u), (4, u + "!")], "doc_id long, text string")
    got = {}
    for r in bwt_dedup.remove_repeats(df).collect():
        got.setdefault(r.doc_id, []).append(len(r.kept))
    assert got[None] == [10] and got[3] == [0, 0]  # the period stays once
    assert sorted(got[4]) in ([1, 17], [0, 18])
    assert bwt_dedup.remove_repeats(df.limit(0)).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op7_bwt_dedup(spark, SF).collect())
    assert got == brute(docs)
    assert any(g[2] for g in got)


def phrase_texts(n):
    """Texts of 1 KB that share a phrase of 31 bytes, and a few repeats."""
    rng = random.Random(3)
    say = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    long = say(300)
    return [say(rng.randint(300, 700)) + " all rights reserved worldwide " + (long if i % 40 == 0 else say(300)) for i in range(n)]


def test_short_phrase_in_all_documents_is_dealt_apart(spark, monkeypatch):
    texts = phrase_texts(600)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    total, limit = sum(map(len, texts)), 12_000
    hot = bwt_dedup.hot_hashes(df.select(bwt_dedup.text_bytes("text").alias("t")), total, limit=limit)
    assert len(hot)
    docs = [(i, 1, t.encode()) for i, t in enumerate(texts)]

    def largest(own):
        """Bytes of pieces under one smallest hash, and rows under one window hash."""
        held, windows = {}, {}
        for bucket, kind, blob in (r for at in range(0, 600, 200) for r in bwt_dedup._batch_rows(docs[at:at + 200], 1, 100, own)):
            if kind == 0:
                p, _ = bwt_dedup._unpack_pieces(blob)
                for v, n in zip(p["value"].tolist(), p["windows"].tolist()):
                    held[v] = held.get(v, 0) + n + 99
            elif kind == 2:
                for v in bwt_dedup._unpack_pieces(blob, bwt_dedup._WINDOW_FIELDS)[0]["high"].tolist():
                    windows[v] = windows.get(v, 0) + 1
        return max(held.values()), max(windows.values(), default=0)

    assert largest(None)[0] > 3 * limit
    assert largest(hot)[0] <= limit and largest(hot)[1] <= 3  # equal windows once per batch
    monkeypatch.setattr(bwt_dedup, "HOT_BYTES", limit)
    got = sorted((r.doc_id, r.n_bytes, sum(r.spans[1::2]) - sum(r.spans[::2]), len(r.spans) // 2, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in bwt_dedup.remove_repeats(df).collect())
    assert got == brute([(i, t.encode()) for i, t in enumerate(texts)]) and any(g[2] for g in got)


def test_all_hashes_hot_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "HOT_BYTES", 1)
    texts = fixture()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(500, None)], "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_bytes, sum(r.spans[1::2]) - sum(r.spans[::2]), len(r.spans) // 2, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in bwt_dedup.remove_repeats(df).collect())
    assert got == brute([(i, t.encode()) for i, t in enumerate(texts)] + [(500, b"")])
