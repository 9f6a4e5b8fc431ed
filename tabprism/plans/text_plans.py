"""Text, keyword and sentiment queries (2G, E2-E4, C6, D14, D15, F2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.functions.binning import (PRICE_BINS_7, case_sql_right_closed, right_closed_bin,
                                        values_sql)
from tabprism.functions.scalar import adaptive_price, normalise_text, round_doubles
from tabprism.operators import bins as B
from tabprism.operators import models as M
from tabprism.operators import stats as S
from tabprism.operators import text as T
from tabprism.operators.attach import attach
from tabprism.operators.quantiles import exact_quantiles
from tabprism.operators.sampling import hash_uniform_bucket, sample_exact, split_stratified
from tabprism.plans.registry import query
from tabprism.session import cut_lineage
from tabprism.sources.listings import listings_clean, oracle_with
from tabprism.sources.tables import read_table

# ----------------------------------------------------------------- shared oracle text
_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"
_TOK_SQL = (r"list_filter(string_split_regex(regexp_replace(lower(description), '[^a-zA-Z\s]', ' ', 'g'), '\s+'), "
            f"lambda w: length(w) >= 4 AND NOT list_contains({_STOP_SQL}, w))")
_LEX_SQL = "lex(word, valence) AS (VALUES " + ", ".join(
    f"('{w}', CAST({v!r} AS DOUBLE))" for w, v in T.LEXICON) + ")"
_DESC_CTE = f"""
, d2 AS (SELECT listing_id, log_price, {_TOK_SQL} AS tokens FROM lc WHERE description IS NOT NULL),
  wc AS (SELECT w AS word, count(*) AS n FROM (SELECT unnest(tokens) AS w FROM d2) u GROUP BY w),
  top5 AS (SELECT word FROM wc ORDER BY n DESC, word LIMIT 5),
  hits AS (SELECT DISTINCT top5.word, d2.listing_id, d2.log_price
           FROM d2, top5 WHERE list_contains(d2.tokens, top5.word)),
  dp AS (SELECT listing_id, CASE WHEN (SELECT max(log_price) FROM d2) < 20 THEN exp(log_price)
                                ELSE log_price END AS price FROM d2)
"""
_NAME_CTE = _LEX_SQL + r""",
  n2 AS (SELECT listing_id, log_price, regexp_replace(lower(name), '^\s+|\s+$', '', 'g') AS name_clean
         FROM lc WHERE name IS NOT NULL),
  nw AS (SELECT listing_id, unnest(string_split_regex(name_clean, '\s+')) AS word FROM n2),
  ns AS (SELECT nw.listing_id, sum(lex.valence) AS s FROM nw JOIN lex ON lex.word = nw.word GROUP BY nw.listing_id),
  sent AS (SELECT n2.listing_id, n2.log_price, n2.name_clean,
                  coalesce(ns.s, 0) / sqrt(coalesce(ns.s, 0) * coalesce(ns.s, 0) + 15) AS score
           FROM n2 LEFT JOIN ns ON ns.listing_id = n2.listing_id),
  lab AS (SELECT *, CASE WHEN score >= 0.05 THEN 'Positive' WHEN score <= -0.05 THEN 'Negative'
                         ELSE 'Neutral' END AS label,
                 CASE WHEN (SELECT max(log_price) FROM sent) < 20 THEN exp(log_price) ELSE log_price END AS price
          FROM sent)
"""
WD = oracle_with() + _DESC_CTE
WN = oracle_with(_NAME_CTE)


# ----------------------------------------------------------------- Spark frames
def description_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned listings with a description: (listing_id, log_price, tokens)."""
    lc = listings_clean(spark, sf, text=("description",)).where(F.col("description").isNotNull())
    return lc.select("listing_id", "log_price", T.clean_tokens("description").alias("tokens"))


def name_sentiment_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Listings with a name: (listing_id, log_price, name_clean, score, label, price)."""
    lc = listings_clean(spark, sf, text=("name",)).where(F.col("name").isNotNull())
    n2 = lc.select("listing_id", "log_price", normalise_text("name").alias("name_clean"))
    scored = T.lexicon_score(n2, "listing_id", "name_clean", T.LEXICON)
    return scored.withColumn("label", T.label_by_threshold("score")) \
                 .withColumn("price", adaptive_price(scored))


# ----------------------------------------------------------------- G1, G2, E2, E3, F2
@query("clean_tokens", "G1", oracle=WD + """SELECT listing_id, CAST(len(tokens) AS INTEGER) AS token_count,
  array_to_string(tokens, ' ') AS tokens_text FROM d2""")
def q_clean_tokens(spark, sf):
    d = description_frame(spark, sf)
    return d.select("listing_id", F.size("tokens").alias("token_count"),
                    F.array_join("tokens", " ").alias("tokens_text"))


@query("word_frequency", "G2", oracle=WD + "SELECT word, n FROM wc")
def q_word_frequency(spark, sf):
    return T.token_counts(description_frame(spark, sf), "tokens")


@query("top_words", "E2", oracle=WD + """SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rnk,
  row_number() OVER (ORDER BY n DESC, word) <= 5 AS is_top5 FROM (SELECT * FROM wc ORDER BY n DESC, word LIMIT 20) t""")
def q_top_words(spark, sf):
    top = T.top_tokens(T.token_counts(description_frame(spark, sf), "tokens"), 20)
    return top.withColumn("is_top5", F.col("rnk") <= 5)


@query("word_weights", "E3", oracle=WD + """SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS rnk,
  round(n / max(n) OVER (), 6) AS weight FROM (SELECT * FROM wc ORDER BY n DESC, word LIMIT 150) t""")
def q_word_weights(spark, sf):
    return round_doubles(T.token_weights(T.token_counts(description_frame(spark, sf), "tokens"), 150))


@query("keyword_semi", "F2", oracle=WD + "SELECT word, listing_id FROM hits")
def q_keyword_semi(spark, sf):
    d = description_frame(spark, sf)
    kw = T.top_word_array(T.token_counts(d, "tokens"), 5)
    return T.rows_with_keywords(d, "tokens", kw, ["listing_id"]).select("word", "listing_id")


# ----------------------------------------------------------------- G3 keyword price buckets
_G3_SQL = WD.replace("WITH ", f"WITH b7(ord, label, lo, hi) AS ({values_sql(PRICE_BINS_7)}), ", 1) + f"""
, hp AS (SELECT hits.word, dp.price, {case_sql_right_closed('dp.price', PRICE_BINS_7)} AS ord
         FROM hits JOIN dp ON dp.listing_id = hits.listing_id),
  cnt AS (SELECT word, ord, count(*) AS n FROM hp WHERE ord IS NOT NULL GROUP BY word, ord),
  dom AS (SELECT top5.word, b7.ord, b7.label FROM top5, b7),
  st AS (SELECT word, avg(price) AS mean_price, quantile_cont(price, 0.5) AS median_price FROM hp GROUP BY word),
  md2 AS (SELECT word, (SELECT ord FROM cnt c2 WHERE c2.word = cnt.word ORDER BY n DESC, ord LIMIT 1) AS mode_ord
          FROM cnt GROUP BY word)
SELECT dom.word, dom.ord, dom.label, coalesce(cnt.n, 0) AS n, round(st.mean_price, 8) AS mean_price,
  round(st.median_price, 8) AS median_price, b7m.label AS mode_label
FROM dom LEFT JOIN cnt ON cnt.word = dom.word AND cnt.ord = dom.ord
JOIN st ON st.word = dom.word
LEFT JOIN md2 ON md2.word = dom.word
LEFT JOIN b7 b7m ON b7m.ord = md2.mode_ord"""


@query("keyword_price_buckets", "G3", oracle=_G3_SQL)
def q_keyword_price_buckets(spark, sf):
    # the tokenized whole texts feed five consumers: materialize them once (reliable
    # checkpoint in the shared folder) instead of re-tokenizing per consumer
    d = cut_lineage(description_frame(spark, sf))
    d = d.withColumn("price", adaptive_price(d))
    kw = T.top_word_array(T.token_counts(d, "tokens"), 5)
    hits = T.rows_with_keywords(d, "tokens", kw, ["listing_id", "price"])
    hits = hits.withColumn("ord", right_closed_bin(F.col("price"), PRICE_BINS_7))
    counts = hits.where(F.col("ord").isNotNull()).groupBy("word", "ord").agg(F.count(F.lit(1)).alias("n"))
    # every top word occurs in at least one row, so the counted words are the domain
    table = B.reindex_counts(counts, PRICE_BINS_7, by=["word"]).select("word", "ord", "label", "n")
    mean = hits.groupBy("word").agg(F.avg("price").alias("mean_price"))
    med = exact_quantiles(hits, "price", [0.5], ["word"], ["median_price"]).drop("n")
    mode = S.mode_by_ordinal(counts, by=["word"]).join(
        F.broadcast(B.bin_table(spark, PRICE_BINS_7).select("ord", F.col("label").alias("mode_label"))), "ord") \
        .select("word", "mode_label")
    out = table.join(mean, "word").join(med, "word").join(mode, "word", "left")
    return round_doubles(out.select("word", "ord", "label", "n", "mean_price", "median_price", "mode_label"), 8)


# ----------------------------------------------------------------- G4, G5, D14, D15, C6, G6
@query("lexicon_sentiment", "G4", oracle=WN + "SELECT listing_id, round(score, 6) AS score FROM sent")
def q_lexicon(spark, sf):
    return round_doubles(name_sentiment_frame(spark, sf).select("listing_id", "score"))


@query("sentiment_label", "G5", oracle=WN + "SELECT listing_id, round(score, 6) AS score, label FROM lab")
def q_sentiment_label(spark, sf):
    return round_doubles(name_sentiment_frame(spark, sf).select("listing_id", "score", "label"))


@query("label_counts", "D15", oracle=WN + "SELECT label, count(*) AS n FROM lab GROUP BY label ORDER BY n DESC")
def q_label_counts(spark, sf):
    return name_sentiment_frame(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query("sentiment_price_summary", "D14", oracle=WN + """SELECT label, round(avg(price), 8) AS mean_price,
  round(quantile_cont(price, 0.5), 8) AS median_price, count(*) AS n FROM lab GROUP BY label""")
def q_sentiment_summary(spark, sf):
    s = name_sentiment_frame(spark, sf)
    m = s.groupBy("label").agg(F.avg("price").alias("mean_price"))
    med = exact_quantiles(s, "price", [0.5], ["label"], ["median_price"])
    return round_doubles(m.join(med, "label").select("label", "mean_price", "median_price", "n"), 8)


def _hist_group_sql(bins: int = 60) -> str:
    return WN + f"""
, p99 AS (SELECT label, quantile_cont(price, 0.99) AS p FROM lab GROUP BY label),
  cl AS (SELECT lab.label, least(lab.price, p99.p) AS v FROM lab JOIN p99 ON p99.label = lab.label),
  r AS (SELECT label, min(v) AS lo, max(v) AS hi FROM cl GROUP BY label),
  c AS (SELECT cl.label, CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((v - r.lo) / ((r.hi - r.lo) / {float(bins)})), {bins - 1}) END AS INTEGER) AS bin,
               count(*) AS n FROM cl JOIN r ON r.label = cl.label GROUP BY 1, 2),
  g AS (SELECT r.*, CAST(x.range AS INTEGER) AS bin FROM r, range({bins}) x)
SELECT g.label, g.bin, round(g.lo + g.bin * (g.hi - g.lo) / {float(bins)}, 8) AS bin_lo,
  round(g.lo + (g.bin + 1) * (g.hi - g.lo) / {float(bins)}, 8) AS bin_hi, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON c.label = g.label AND c.bin = g.bin"""


@query("histogram_by_group", "C6", oracle=_hist_group_sql())
def q_hist_group(spark, sf):
    s = name_sentiment_frame(spark, sf)
    p99 = exact_quantiles(s, "price", [0.99], ["label"], ["p99"]).drop("n")
    cl = attach(s, p99, ["label"]).select("label", F.least("price", "p99").alias("v"))
    return round_doubles(B.histogram(cl, "v", 60, by=["label"]), 8)


def _kde_by_label():
    from tabprism.plans.profile_plans import _kde_parts
    ctes, select = _kde_parts("k", 400, "label", 10)
    return WN + """
, p99 AS (SELECT label, quantile_cont(price, 0.99) AS p FROM lab GROUP BY label),
  k AS (SELECT lab.label, least(lab.price, p99.p) AS v FROM lab JOIN p99 ON p99.label = lab.label)
""" + ctes + select


@query("kde_by_sentiment", "D12", oracle=_kde_by_label())
def q_kde_by_sentiment(spark, sf):
    """Density of the clipped price per sentiment label, for labels of over 10 rows."""
    s = name_sentiment_frame(spark, sf)
    p99 = exact_quantiles(s, "price", [0.99], ["label"], ["p99"]).drop("n")
    cl = attach(s, p99, ["label"]).select("label", F.least("price", "p99").alias("v"))
    return round_doubles(S.kde(cl, "v", 400, by=["label"], min_n=10))


# Word context on whole documents. The lexicon is the 300 most frequent words, each with a valence by
# hash; the corpus is invented, so words that occur in it stand for negations and intensifiers.
_NEGATIONS, _BOOSTERS = ["not", "no", "by", "der", "ou"], {"very": 0.293, "that": 0.293, "ein": 0.293, "est": -0.293}
_BOOST_SQL = "CASE p1 " + " ".join(f"WHEN '{w}' THEN {b}" for w, b in _BOOSTERS.items()) + " ELSE 0.0 END"
_NEG_SQL = " OR ".join(f"coalesce(p{k} IN ({', '.join(repr(w) for w in _NEGATIONS)}), false)" for k in (1, 2, 3))


@query("lexicon_context", "G4", oracle=f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+') AS t FROM documents),
  tok AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM d),
  lex AS (SELECT w AS word, ((('0x' || substr(md5(w), 1, 4))::INT % 9) - 4) / 2.0 AS v FROM
          (SELECT w, count(*) AS n FROM tok WHERE length(w) >= 3 GROUP BY w ORDER BY n DESC, w LIMIT 300) x),
  ctx AS (SELECT doc_id, w, lag(w, 1) OVER o AS p1, lag(w, 2) OVER o AS p2, lag(w, 3) OVER o AS p3 FROM tok
          WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
  hit AS (SELECT doc_id, (v + sign(v) * {_BOOST_SQL}) * CASE WHEN {_NEG_SQL} THEN -0.74 ELSE 1.0 END AS x
          FROM ctx JOIN lex ON w = word),
  sm AS (SELECT doc_id, sum(x)::DOUBLE AS s FROM hit GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 6) AS score FROM d LEFT JOIN sm USING (doc_id)""")
def q_lexicon_context(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", T.plain_words("text").alias("t"))
    words = docs.select(F.explode("t").alias("word")).where(F.length("word") >= 3).groupBy("word").count()
    valence = (F.pmod(F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("int"), F.lit(9)) - 4) / 2.0
    lexicon = words.orderBy(F.desc("count"), "word").limit(300).select("word", valence.alias("valence"))
    return round_doubles(T.context_score(docs, "doc_id", "t", lexicon, _NEGATIONS, _BOOSTERS))


@query("sentiment_trend", "G6", oracle=WN + """
, s AS (SELECT * FROM lab ORDER BY md5(CAST(listing_id AS VARCHAR) || '|42'), listing_id LIMIT 5000),
  c AS (SELECT score, least(price, (SELECT quantile_cont(price, 0.99) FROM s)) AS y FROM s)
SELECT count(*) AS n, round(regr_slope(y, score), 6) AS slope, round(regr_intercept(y, score), 6) AS intercept FROM c""")
def q_sentiment_trend(spark, sf):
    s = cut_lineage(sample_exact(name_sentiment_frame(spark, sf), "listing_id", 5000, 42))  # read twice
    p99 = exact_quantiles(s, "price", [0.99], names=["p99"]).select("p99").scalar()
    c = s.select("score", F.least("price", p99).alias("y"))
    return round_doubles(c.agg(F.count(F.lit(1)).alias("n"), F.regr_slope("y", "score").alias("slope"),
                               F.regr_intercept("y", "score").alias("intercept")))


# ----------------------------------------------------------------- G7, G8, E4, G9
def binary_split(spark: SparkSession, sf: str) -> DataFrame:
    """Positive/Negative names with an exact stratified 80/20 split (H2)."""
    s = name_sentiment_frame(spark, sf).where(F.col("label").isin("Positive", "Negative"))
    sp = split_stratified(s.select("listing_id", "name_clean", "label"), "listing_id", "label", 0.2, 42)
    # read several times downstream (document count, vocabulary, weights, fit, scoring)
    return cut_lineage(sp)


_G7_SQL = WN + r"""
, bn AS (SELECT listing_id, name_clean, label FROM lab WHERE label IN ('Positive', 'Negative')),
  rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(listing_id AS VARCHAR) || '|42') || '|'
                   || CAST(listing_id AS VARCHAR)) - 1 AS r, count(*) OVER (PARTITION BY label) AS nl FROM bn),
  tr AS (SELECT * FROM rk WHERE r >= ceil(0.2 * nl)),
  tk AS (SELECT listing_id, regexp_extract_all(lower(name_clean), '\b\w\w+\b') AS t FROM tr),
  terms AS (SELECT listing_id, unnest(list_concat(t, list_transform(range(1, len(t)),
            lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM tk),
  tf AS (SELECT listing_id, term, count(*) AS tf FROM terms GROUP BY listing_id, term),
  st AS (SELECT term, count(*) AS df, sum(tf) AS tfs FROM tf GROUP BY term HAVING count(*) >= 2),
  voc AS (SELECT term, df FROM st ORDER BY tfs DESC, term LIMIT 10000),
  nd AS (SELECT count(*) AS n FROM tr),
  w AS (SELECT tf.listing_id, tf.term, (1 + ln(tf.tf)) * (ln((1.0 + nd.n) / (1.0 + voc.df)) + 1) AS w
        FROM tf JOIN voc ON voc.term = tf.term, nd),
  nr AS (SELECT listing_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY listing_id)
SELECT w.listing_id, w.term, round(w.w / nr.nrm, 6) AS weight FROM w JOIN nr ON nr.listing_id = w.listing_id"""


@query("tfidf_ngrams", "G7", oracle=_G7_SQL)
def q_tfidf(spark, sf):
    sp = binary_split(spark, sf)
    train = sp.where(F.col("split") == "train")
    weights, _ = T.tfidf(train, "listing_id", "name_clean", min_df=2, max_features=10000)
    return round_doubles(weights)


_classifiers: dict[tuple[str, str], M.TextClassifier] = {}


def name_classifier(spark: SparkSession, sf: str) -> M.TextClassifier:
    """The folder's classifier of names, fitted once a session for all queries that speak of it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _classifiers:
        _classifiers[key] = M.fit_text_classifier(binary_split(spark, sf), "listing_id", "name_clean", "label", positive="Positive")
    return _classifiers[key]


@query("sentiment_classifier", "G8")
def q_classifier(spark, sf):
    return name_classifier(spark, sf).predictions().select("listing_id", "label", "prediction", "split")


@query("classifier_stationarity", "G8", oracle=_G7_SQL[:_G7_SQL.rindex("SELECT w.listing_id")] +
       "SELECT term, CAST(0 AS DOUBLE) AS gradient FROM voc UNION ALL SELECT NULL, 0.0")
def q_classifier_stationarity(spark, sf):
    """Gradient of the classifier's penalised loss by term: 0 for an exact fit on the right vocabulary."""
    return round_doubles(M.classifier_gradients(name_classifier(spark, sf)))


@query("top_coefficients", "E4")
def q_top_coefficients(spark, sf):
    return M.top_terms(name_classifier(spark, sf), 15)


_G9_SQL = oracle_with() + """
, sp AS (SELECT *, CASE WHEN b < 6 THEN 'train' WHEN b < 8 THEN 'val' ELSE 'test' END AS split
         FROM (SELECT *, (('0x' || substr(md5(CAST(listing_id AS VARCHAR) || '|42'), 1, 8))::BIGINT) % 10 AS b FROM lc) x),
  cm AS (SELECT city, room_type, count(*) AS c FROM sp WHERE split = 'train' GROUP BY city, room_type),
  md AS (SELECT city, (SELECT room_type FROM cm c2 WHERE c2.city = cm.city ORDER BY c DESC, room_type LIMIT 1) AS yhat
         FROM cm GROUP BY city),
  te AS (SELECT sp.room_type AS y, md.yhat FROM sp JOIN md ON md.city = sp.city WHERE split = 'test'),
  pairs AS (SELECT y, yhat, count(*) AS c FROM te GROUP BY y, yhat),
  sup AS (SELECT y AS label, sum(c) AS support FROM pairs GROUP BY y),
  pre AS (SELECT yhat AS label, sum(c) AS pred FROM pairs GROUP BY yhat),
  tp AS (SELECT y AS label, c AS tp FROM pairs WHERE y = yhat),
  per AS (SELECT coalesce(sup.label, pre.label) AS label, coalesce(support, 0) AS support,
                 coalesce(pred, 0) AS pred, coalesce(tp.tp, 0) AS tp
          FROM sup FULL JOIN pre ON sup.label = pre.label LEFT JOIN tp ON tp.label = coalesce(sup.label, pre.label)),
  m AS (SELECT label, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM per),
  m2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM m2"""


@query("classification_report", "G9", oracle=_G9_SQL)
def q_classification_report(spark, sf):
    lc = listings_clean(spark, sf)
    b = hash_uniform_bucket("listing_id", 42, 10)
    sp = lc.withColumn("split", F.when(b < 6, "train").when(b < 8, "val").otherwise("test"))
    counts = sp.where(F.col("split") == "train").groupBy("city", "room_type").agg(F.count(F.lit(1)).alias("c"))
    mode = counts.groupBy("city").agg(F.min_by("room_type", F.struct(-F.col("c"), F.col("room_type"))).alias("yhat"))
    te = attach(sp.where(F.col("split") == "test"), mode, ["city"]).select(F.col("room_type").alias("y"), "yhat")
    return round_doubles(T.classification_report(te, "y", "yhat"))
