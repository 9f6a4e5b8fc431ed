import hashlib
import random

from tabprism.llm import line_runs, queries
from tests.llm.helpers import SF, brute_lines, duck_rows, spark_rows

LONG = "This line is a footer that many of the pages share, WITH Capitals"


def rows():
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(9)}" for _ in range(20)) for _ in range(30)]
    out = []
    for i in range(80):
        lines = [rng.choice(texts) for _ in range(rng.randint(0, 6))] + [LONG.upper() if i % 3 else f" {LONG}\t", "short", ""]
        rng.shuffle(lines)
        out.append((i * 13 % 997, "\n".join(lines)))
    # ties, repeated rows, nulls, empties, one very long text, 40 code points but more bytes
    out += [(5000, LONG), (5000, LONG), (5000, "x\n" + LONG), (None, LONG), (6001, None), (6002, ""), (6003, "\n\n")]
    out += [(6100 + i, "é" * 39 + "\n" + "é" * 40 + "\r") for i in range(6)]
    out += [(7000, "\n".join(texts * 300)), (None, "z" * 50), (None, "z" * 50), (None, "z" * 50), (None, "z" * 50), (None, "z" * 50)]
    return out


def test_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(d, t, "k", 3) for d, t in data], "doc_id long, text string, key string, n_lines int")
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256, r.kept_text) for r in line_runs.dedup_lines(df).collect())
    want = sorted((str(d), n, gone, hashlib.sha256("\n".join(k).encode()).hexdigest(), "\n".join(k)) for d, k, n, gone in brute_lines(data))
    assert got == want
    clean = line_runs.without_common_lines(df)
    assert clean.columns == df.columns
    kept = sorted((str(d), None if t is None else "\n".join(k)) for (d, k, _, _), (_, t) in zip(brute_lines(data), data))
    assert sorted(map(repr, kept)) == sorted(repr((str(r.doc_id), r.text)) for r in clean.collect())


def test_batches_and_levels_give_the_same_index(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    keys = line_runs.line_keys(df, "doc_id", "text")
    one, many = line_runs.LineRuns(spark), line_runs.LineRuns(spark, fanout=2)
    one.add(keys)
    for b in range(7):
        many.add(keys.where(f"pmod(row, 7) = {b}"))
    assert [len(x) for x in many.levels] == [1, 1, 1]
    drops = lambda runs: sorted((str(r.id), r.row, bytes(r.key)) for r in runs.drops(keys).collect())
    assert drops(one) == drops(many)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.dedup_lines(df).count() == 0


def test_query_matches_sql(spark):
    assert spark_rows(queries.op10_line_runs(spark, SF)) == duck_rows(queries.OP10_SQL)
