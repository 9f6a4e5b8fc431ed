import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tabprism.llm import bpe_dp, queries
from tests.llm.helpers import SF

FILE = queries.tokenizer_file("byte_bpe_50k.json")
CASES = ["", " ", "\n", "a", "aaaaaaaaaaaaaaaa", "a" * 501, "  x\n\n\n y \t z  ", "é\x85 　x \x1c\x1d a", "a\x1c b\x1f\x1f c",
         "<|endoftext|>hi<|endoftext|> <|endoftext", "'s 'S don't we'll I'M", "日本語テキスト 漢字 12345 ½", "́a", "zz" * 333,
         "=-=-=-=-=-" * 40, "👩‍👩‍👧 \U0001d518", " a  b   c\n d\n\ne \n\n f\t\tg \xa0 h　　i", "   ", "\n \n", " x ",
         "a  b c   d   e"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_ids_and_text_equal_the_library(library):
    rng = random.Random(11)
    cases = list(CASES)
    for _ in range(4000):
        letters = rng.choice(["ab", "abcde \n'", "thein ra", "aA1 -=\t", "éà́ 日"])
        cases.append("".join(rng.choice(letters) for _ in range(rng.randint(1, 40))))
    mine = bpe_dp.BpeTables(FILE)
    for text, ids in zip(cases, mine.encode_batch(cases)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert mine.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_every_prefix_has_the_last_token_of_its_encoding(library):
    mine = bpe_dp.BpeTables(FILE)
    word = "nderstthhedingtionaaaa"
    for n in range(1, len(word) + 1):
        assert np.frombuffer(mine.encode_words([word[:n]])[0], "<i4").tolist() == library.encode(word[:n], add_special_tokens=False).ids


def test_decode_of_broken_bytes(library):
    mine = bpe_dp.BpeTables(FILE)
    ids = library.encode("日本é", add_special_tokens=False).ids
    for cut in range(len(ids) + 1):
        assert mine.decode(np.array(ids[:cut], np.int64)) == library.decode(ids[:cut], skip_special_tokens=False)


def test_memo_limit_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_dp, "MEMO_BYTES", 2000)
    monkeypatch.setattr(bpe_dp, "PAIRS", 10)
    mine = bpe_dp.BpeTables(FILE)
    text = "the of and to a in is that, it. for on? was with as be by this are at from"
    for part in (text, text[::-1], text * 3):
        assert mine.encode(part).tolist() == library.encode(part, add_special_tokens=False).ids


def test_full_memo_keeps_what_the_batch_uses(library, monkeypatch):
    mine, learned = bpe_dp.BpeTables(FILE), []
    real = mine.encode_words
    monkeypatch.setattr(mine, "encode_words", lambda words: learned.append(set(words)) or real(words))
    rare = lambda k: [" ".join(f"r{chr(97 + k)}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))]
    monkeypatch.setattr(bpe_dp, "MEMO_BYTES", 60_000)
    common = "the frequent words of every batch "
    for k in range(4):
        texts = [common * 5 + t for t in rare(k)]
        for text, ids in zip(texts, mine.encode_batch(texts)):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert mine._held <= 60_000 + 300 * (bpe_dp.MEMO_ENTRY + 40)
    assert sum(" frequent" in words for words in learned) == 1
    monkeypatch.setattr(bpe_dp, "MEMO_BYTES", 10)  # what the batch uses is too much itself
    mine.encode_batch([common])
    assert mine.encode(common).tolist() == library.encode(common, add_special_tokens=False).ids and len(mine.memo) < 30


def test_query_and_edge_rows(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op6_bpe_dp(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
    edge = spark.createDataFrame([(None, None, 1), (3, "", 2), (3, "", 2), (4, "word " * 60_000, 3)], "doc_id long, text string, ids int")
    rows = bpe_dp.encode_decode(edge, FILE).collect()
    assert sorted((str(r.doc_id), len(r.ids), len(r.decoded)) for r in rows) == [("3", 0, 0), ("3", 0, 0), ("4", 60_001, 300_000), ("None", 0, 0)]
    assert bpe_dp.encode_decode(edge.limit(0), FILE).count() == 0


def test_memo_stays_within_its_bytes_and_is_dropped(monkeypatch):
    own = bpe_dp.BpeTables(queries.tokenizer_file("byte_bpe_50k.json"))
    library = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    monkeypatch.setattr(bpe_dp, "MEMO_BYTES", 30_000)
    draw = random.Random(8)
    for _ in range(20):
        text = " ".join("".join(draw.choice("etaoin") for _ in range(draw.randrange(1, 90))) for _ in range(40)) + "z" * 5000
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert own._held <= 30_000 + 40 * (64 * 5 + bpe_dp.MEMO_ENTRY)
        assert own._held == sum(len(c) + len(x) + bpe_dp.MEMO_ENTRY for c, x in own.memo.items())
        assert all(len(c) <= bpe_dp.MEMO_CHARS for c in own.memo)
    own.forget()
    assert not own.memo and not own._held
