import base64
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import SF
from tabprism.llm import bpe_matrix, queries

PATH = queries.tokenizer_file("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe_matrix.RankEncoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(own, library, texts):
    for text, ids in zip(texts, own.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text[:80]
        assert own.decode(ids) == text.encode()


def test_equals_the_library_on_odd_texts(own, library):
    same(own, library, ["", " ", "\n", "hello  world\n\n  x", "I'll don't 123abc", "é漢字 <|endoftext|>", "   \n \t x", "a\x1cb \x85 c　d", "\x1f", "🙂🙂 ok",
                        "they're 'S's", "x" * 257, "ab" * 700, "=" * 1000, "漢" * 900])


def test_equals_the_library_on_random_texts(own, library):
    draw = random.Random(5)
    same(own, library, ["".join(draw.choice("abehtisno ,.\n1é漢") for _ in range(draw.randrange(300))) for _ in range(500)])
    same(own, library, ["".join(draw.choice("abehtisnoer") for _ in range(draw.randrange(200, 3000))) for _ in range(10)])  # folded rows


def test_folded_rows_equal_the_matrix(own):
    draw = random.Random(6)
    for _ in range(30):
        piece = "".join(draw.choice("aetn") for _ in range(draw.randrange(2, 250))).encode()
        assert own._folded(piece).tobytes() == own.encode_pieces([piece])[0] or piece in own.ids


def test_another_pattern_and_small_ranks(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"xab", b"aa", b"aaaa"]
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    pattern = r"[abcx]+|[^abcx]+"
    own = bpe_matrix.RankEncoder(str(path), pattern)
    library = tiktoken.Encoding("small", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    draw = random.Random(7)
    same(own, library, ["".join(draw.choice("aabcx -") for _ in range(draw.randrange(60))) for _ in range(300)])


def test_rank_file_without_all_bytes_is_refused(tmp_path):
    path = tmp_path / "bad.tiktoken"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        bpe_matrix.RankEncoder(str(path))


def test_memo_stays_within_its_bytes(monkeypatch, library):
    own = bpe_matrix.RankEncoder(PATH, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe_matrix, "MEMO_BYTES", 20_000)
    draw = random.Random(8)
    for _ in range(20):
        texts = [" ".join("".join(draw.choice("etaoin") for _ in range(draw.randrange(1, 90))) for _ in range(40))]
        same(own, library, texts)
        assert own._held <= 20_000 + 40 * (90 * 5 + bpe_matrix.MEMO_ENTRY)
        assert all(len(c) <= bpe_matrix.MEMO_CHARS for c in own._memo)


def test_long_unbroken_run_ends_in_time(own):
    began = time.process_time()
    text = "acgt" * 25_000
    ids = own.encode_batch([text])[0]
    assert own.decode(ids) == text.encode()
    assert time.process_time() - began < 30


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_bpe_matrix(spark, SF).collect()
    assert {r.doc_id for r in rows} == docs.keys() and len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_extra_columns_and_empty(spark, library):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 50_000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = {(r.doc_id, r.n_tokens): r for r in bpe_matrix.encode_decode(df, PATH).collect()}
    assert set(out) == {(None, 0), (1, 0), (2, len(library.encode_ordinary("word " * 50_000)))}
    assert bytes(out[(1, 0)].ids) == b"" and bpe_matrix.encode_decode(df, PATH).count() == 4
    assert bpe_matrix.encode_decode(df.limit(0), PATH).collect() == []
