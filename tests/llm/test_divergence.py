import random
import re

from tabprism.llm import divergence, queries
from tests.llm.helpers import SF, duck_rows, spark_rows


def test_query_matches_sql(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        assert spark_rows(queries.op3_divergence(spark, sf)) == duck_rows(queries.OP3_SQL, sf)


def brute(text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    wins, seen = [tuple(words[i:i + 8]) for i in range(len(words) - 7)], {}
    for i, w in enumerate(wins):
        seen.setdefault(w, []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_base_figures_against_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", " \t\n", "a", "é\xa0ü b", "\n\na b\n a b\na b\n", "x " * 8, "x " * 9, "#*$%&|<> " * 4]
    for _ in range(60):
        part = [rng.choice("abcde") for _ in range(rng.randint(3, 30))]
        texts.append(rng.choice([" ", "\n", "\x0b"]).join(part * rng.randint(1, 3) + [rng.choice("abc") for _ in range(rng.randint(0, 40))]))
    texts.append(" ".join(str(rng.randrange(50_000)) for _ in range(30_000)))
    df = spark.createDataFrame([(i, t, None if i % 2 else "en", "own", 5) for i, t in enumerate(texts)], "doc_id long, text string, lang string, kept string, n_words int")
    got = {r.doc_id: r for r in divergence.quality(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), (i, t and t[:50])
        assert not (r.base_failed and r.kept)
    good = divergence.keep_good(df)
    assert good.columns == df.columns
    assert good.count() == sum(r.kept for r in got.values())


def test_labelled_junk_goes_and_clean_stays(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op3_divergence(spark, sf).where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) <= .01 * n[(1, True)]
    assert n.get((0, True), 0) <= .05 * n[(0, False)]


def test_repeated_and_null_ids_and_empty(spark):
    text = "some words " * 15
    df = spark.createDataFrame([(None, text, "xx"), (None, text, "xx"), (1, None, None), (1, None, None)], "doc_id long, text string, lang string")
    assert divergence.quality(df).count() == 4
    assert divergence.quality(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = queries.op3_divergence(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
