"""Behaviour asked for after the first round."""
import math

import pytest
from pyspark.sql import functions as F

from tabprism.operators import models as M
from tabprism.operators import stats as S
from tabprism.operators.attach import attach
from tabprism.operators.quantiles import exact_quantiles, ranked_counts
from tabprism.sources.listings import clean_target
from tests.conftest import SF_SMALL


def test_quantiles_do_not_depend_on_partitions(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.pow(F.col("id") % 701, 1.5)).alias("v"))
    want = sorted(map(tuple, df.groupBy("g").agg(*[F.percentile("v", q) for q in (0.01, 0.5, 0.99)]).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = sorted(map(tuple, exact_quantiles(df, "v", [0.01, 0.5, 0.99], ["g"]).drop("n").collect()))
            assert [g[0] for g in got] == [w[0] for w in want]
            assert all(math.isclose(a, b, rel_tol=1e-12) for g, w in zip(got, want) for a, b in zip(g, w))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    r = ranked_counts(df, "v", ["g"])
    assert r.agg(F.sum("_cnt")).first()[0] == 3000


def test_nan_target_is_dropped(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (4, -1.0)], "listing_id long, log_price double")
    assert [r.listing_id for r in clean_target(df).collect()] == [1]


def test_pivot_takes_its_columns_from_the_data(spark):
    df = spark.createDataFrame([("a", "F", 1.0), ("a", "Z", 9.0), ("b", "O", 2.0)], "city string, room string, v double")
    out = {r.city: r for r in S.pivot_mean(df, "city", "room", "v", "room_").collect()}
    assert out["a"].room_Z == 9.0 and out["a"].has_global_max and not out["b"].has_global_max


def test_small_statistics_do_not_shuffle_the_rows(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = attach(rows, rows.groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("m")), ["o_orderstatus"])
    assert out.count() == rows.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(o_orderstatus" not in plan


def test_labels_state_their_own_parameters():
    grid = M.model_grid()
    assert len(grid) == 24 and len({(c.family, c.label) for c in grid}) == 24
    for c in grid:
        small = M.reduced(c, 0.05)
        assert (small.label == c.label) == (small.params == c.params)
        assert small.params.get("max_depth") == c.params.get("max_depth")
    assert [c.label for c in grid if c.family == "XGBoost"][4:] == ["C5: n=300,d=8,lr=0.03,L1=0.1", "C6: n=500,d=6,lr=0.02,L1=0.1,L2=2"]


def test_name_sentiment_reads_no_documents(spark):
    from tabprism.plans.registry import entries
    plan = entries()["sentiment_label"].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "part.parquet" in plan


def test_lexicon_table_and_pairs_score_alike(spark):
    from tabprism.operators import text as T
    df = spark.createDataFrame([(1, "green red none"), (2, ""), (3, "x y")], "k long, t string")
    word = T.LEXICON[0][0]
    df = df.unionAll(spark.createDataFrame([(4, f"{word} {word} q")], "k long, t string"))
    one = sorted(map(tuple, T.lexicon_score(df, "k", "t", T.LEXICON).collect()))
    assert one == sorted(map(tuple, T.lexicon_score(df, "k", "t", T.lexicon_table(spark)).collect()))


def test_cluster_without_shared_folder_is_refused(spark):
    from tabprism import session

    class Fake:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class FakeSession:
        sparkContext = Fake()
        conf = Fake()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(FakeSession())


def test_strict_percentages_raise(spark):
    import pytest
    from tabprism.functions.scalar import parse_percent
    good = spark.createDataFrame([("95%",), (None,), ("7",)], "p string")
    assert [r.v for r in good.select(parse_percent("p", strict=True).alias("v")).collect()] == [95.0, None, 7.0]
    bad = spark.createDataFrame([("N/A",)], "p string")
    assert bad.select(parse_percent("p").alias("v")).first().v is None
    with pytest.raises(Exception, match="no percentage"):
        bad.select(parse_percent("p", strict=True).alias("v")).collect()


def test_word_context_negates_and_strengthens(spark):
    from tabprism.operators import text as T
    rows = [(1, "good"), (2, "very good"), (3, "not a very good"), (4, "not one two three good"), (5, "bad very"), (6, None), (7, "very bad")]
    df = spark.createDataFrame(rows, "k long, s string").select("k", T.plain_words("s").alias("t"))
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "word string, valence double")
    got = {r.k: r.score for r in T.context_score(df, "k", "t", lex, ["not"], {"very": 0.293}).collect()}
    norm = lambda s: s / (s * s + 15) ** 0.5
    want = {1: norm(2.0), 2: norm(2.293), 3: norm(-0.74 * 2.293), 4: norm(2.0), 5: norm(-2.0), 6: 0.0, 7: norm(-2.293)}
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()) and len(got) == 7
