import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabprism.llm import mph_index, queries
from tests.llm.helpers import SF

FILE = queries.tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_encoder_equals_the_library(library):
    rng = random.Random(7)
    cases = ["", " ", "Hello WORLD's don't  'S", "a\x1cb \x1f c", "é é ́x İ Σας ΑΣ", "x y　z\x85w\xa0v", "<|endoftext|> a<|startoftext|>b<|endoftext|",
             "日本 12345 ½ 👩‍👩‍👧", "a " * 3000, "b" * 5000, "\t\n\r\x0b\x0c"]
    cases += ["The end. And, so on... (it), 3.5, x., y,, z.\n'S. don't, ŒUVRE ÀÉÎÕÜ ŸžĲǄ ŉ ß. İ, I'LL.", "ABC<|ENDOFTEXT|> <|endoftext|>, x.", "x<|ENDOFTEXT|>y"]
    for _ in range(2500):
        letters = rng.choice(["ab \n", "Ab., '\n", "éÉàßİŸǅ,. a", "thein ra,.", "aA1 -=\t'", "éà́ 日ǅ"])
        cases.append("".join(rng.choice(letters) for _ in range(rng.randint(1, 60))))
    mine = mph_index.encoder(FILE)
    assert mine.word_wise and mine.type == np.dtype("<u2")
    for text, ids in zip(cases, mine.encode_batch(cases)):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_whole_texts_for_other_files():
    path = queries.tokenizer_file("byte_bpe_50k.json")
    mine, text = mph_index.encoder(path), "two  words\n"
    assert not mine.word_wise
    assert np.frombuffer(mine.encode_batch([text])[0], "<u2").tolist() == Tokenizer.from_file(path).encode(text).ids


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 64, 5000):
        a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        own = mph_index.PerfectHash.build(a, b)
        assert sorted(own.slots(a, b).tolist()) == list(range(n))
    places = np.stack([np.arange(n), np.arange(n) * 2, np.ones(n, int)], axis=1)
    import io
    bucket = mph_index.Bucket(dict(np.load(io.BytesIO(mph_index.Bucket.pack(np.r_[a, a[:3]], np.r_[b, b[:3]], np.r_[places, places[:3] + 7])))))
    key, place = bucket.find(a, b)
    assert sorted(zip(key.tolist(), place[:, 0].tolist())) == sorted([*((i, i) for i in range(n)), *((i, i + 7) for i in range(3))])
    key, _ = bucket.find(rng.integers(0, 1 << 63, 20000, dtype=np.uint64), rng.integers(0, 1 << 63, 20000, dtype=np.uint64))
    assert len(key) == 0


def expected(rows, library):
    """In ascending id order: id, start, ids with the end id."""
    start, out = 0, []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, ids))
        start += len(ids)
    return out


def test_query(spark, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op1_mph_index(spark, SF).collect())
    assert got == [(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, s, i in expected(docs, library)]


def test_edge_rows_and_keyed_access(spark, library):
    rows = [(None, "null key"), (1, None), (2, ""), (3, "same row"), (3, "same row"), (3, "another text"), (9, "word " * 40_000), (-5, "Low")]
    rows += [(10 + i, f"doc {i}") for i in range(200)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, shard int")
    index = mph_index.write_index(df, FILE, 2, shard_bytes=4000)
    found = mph_index.lookup(index, df).collect()
    assert len(found) == len(rows)
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    assert [r.doc_id for r in by_start] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    ids = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in found)
    assert ids == sorted((str(d), i) for d, _, i in expected(rows, library))
    asked = spark.createDataFrame([(3,), (3,), (150,), (123456,), (None,)], "doc_id long")
    assert sorted(str(r.doc_id) for r in mph_index.lookup(index, asked).collect()) == ["150", "3", "3", "3", "None"]
    empty = mph_index.write_index(df.limit(0), FILE, 2)
    assert mph_index.lookup(empty, asked).count() == 0


def test_folders_of_object_stores_get_arrow_names():
    for given, want in (("/tmp/x", "/tmp/x"), ("file:/tmp/a b", "file:/tmp/a b"), ("s3a://bucket/a:b/c", "s3://bucket/a:b/c"), ("S3N://b/c", "s3://b/c"),
                        ("hdfs://host:8020/x", "hdfs://host:8020/x"), ("gcs://b/c", "gs://b/c"), ("abfss://c@a/x", "abfss://c@a/x")):
        assert mph_index.arrow_uri(given) == want
    with pytest.raises(ValueError, match="dbfs"):
        mph_index.arrow_uri("dbfs:/tmp/x")
