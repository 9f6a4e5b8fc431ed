import hashlib
import json

import corpus_pipeline
from tests.llm.helpers import SF, brute_lines, duck_rows
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_simhash import brute_components, brute_print
from tabprism.llm import queries
from tokenizers import Tokenizer


def brute(rows, kept, items):
    """(doc_id, ids) after all stages; rows: (doc_id, text); kept: ids that stage 1 keeps."""
    rows = [(d, "\n".join(lines)) for d, lines, _, _ in brute_lines([r for r in rows if r[0] in kept])]
    root = brute_components([brute_print(t) for _, t in rows])
    first = {}
    for d, t in sorted(rows):
        first.setdefault(root[brute_print(t)], (d, t))
    rows = sorted(first.values())
    leaking = {int(d) for d, *_ in brute_leaks(rows, items)}
    library = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    return {d: (library.encode(t, add_special_tokens=False).ids, t) for d, t in rows if d not in leaking}


def test_run_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in duck_rows(queries.OP3_SQL) if r["kept"]}
    want = brute(docs, kept, items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == want.keys()
    assert 0 < len(got) < len(kept) < len(docs)
    for d, (ids, text) in want.items():
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_handle_nulls_repeats_extra_columns_and_empty(spark):
    text = " ".join(f"word{i % 37} and the of" for i in range(60))
    rows = [(1, text, "en", "a", 5, 1.5), (1, text, "en", "a", 5, 1.5), (None, text + " tail", None, None, None, None), (2, None, "en", "b", 0, 0.0),
            (3, "", "en", "b", 0, 0.0), (4, "x " * 30_000, "de", "b", 0, 0.0), (5, "\n".join(f"line {i} of a long table of numbers {i * i}" for i in range(400)), "fr", "b", 9, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    for make in (df, df.limit(0)):
        docs = make
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == df.columns, name
            assert out.count() <= docs.count()
            docs = out
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.count() == docs.count()


def test_pipeline_is_registered():
    assert queries.queries()["pipeline"] is queries.pipeline
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES])
