"""Text operators (section 2G, E2-E4): tokens, counts, lexicon sentiment, TF-IDF.

Tokenising is a chain of built-in regex/array expressions (JVM, codegen); the
corpus statistics are explode + aggregate; every vocabulary-sized table that is
broadcast has its size capped by construction (top-k) or is a fixed lexicon.
Whole texts are processed, never prefixes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprism.operators.attach import attach

# The reference's stop-word list (42 words, domain words included).
STOP_WORDS = ["the", "a", "an", "and", "or", "in", "of", "to", "is", "with", "for", "at",
              "on", "by", "this", "that", "are", "be", "it", "as", "from", "you", "your",
              "our", "we", "has", "have", "will", "can", "was", "but", "not", "all",
              "more", "very", "also", "s", "room", "apartment", "airbnb", "home", "house"]

# Our valence lexicon for listing names (words drawn from part names;
# most words are deliberately left out so that many names score neutral).
LEXICON = [("new", 1.8), ("large", 1.1), ("hot", 0.9), ("cold", -0.9), ("old", -1.3),
           ("small", -0.6)]

# VADER-style normalisation constant and label thresholds.
SENTIMENT_ALPHA = 15.0
POSITIVE_AT = 0.05
NEGATIVE_AT = -0.05

# Word pattern of the TF-IDF tokenizer (2+ word characters).
TFIDF_TOKEN = r"(?U)\b\w\w+\b"


def clean_tokens(c: Column | str, stop: Sequence[str] = STOP_WORDS, min_len: int = 4) -> Column:
    """G1: lower-case, non-letters -> space, split on whitespace, drop stop words and
    words shorter than ``min_len`` letters."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(F.lower(c), r"(?U)[^a-zA-Z\s]", " ")
    words = F.split(text, r"(?U)\s+")
    # ``isin`` over a literal list becomes a hash-set lookup (InSet), not a list scan
    return F.filter(words, lambda w: (F.length(w) >= min_len) & ~w.isin(list(stop)))


def token_counts(df: DataFrame, tokens: str) -> DataFrame:
    """Corpus frequency per word (explode + partial/final aggregate)."""
    return (df.select(F.explode(tokens).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def top_tokens(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words (ties by word), ranked 1..k.

    ``orderBy().limit()`` is planned as TakeOrderedAndProject (k rows per task), and
    the rank is assigned over those k rows only.
    """
    top = counts.orderBy(F.desc("n"), F.col("word")).limit(k)
    return top.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("n"), F.col("word"))))


def token_weights(counts: DataFrame, k: int = 150) -> DataFrame:
    """Up to ``k`` words with frequency relative to the most frequent one."""
    top = top_tokens(counts, k)
    # the window spans the k selected rows only
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))


def top_word_array(counts: DataFrame, k: int) -> Column:
    """The top-``k`` words as one array value (scalar subquery; k is the bound)."""
    top = top_tokens(counts, k)
    return top.agg(F.sort_array(F.collect_list(F.struct(F.col("rnk"), F.col("word")))).alias("_a")) \
              .select(F.transform("_a", lambda s: s["word"])).scalar()


def rows_with_keywords(df: DataFrame, tokens: str, keywords: Column, keep: Sequence[str]) -> DataFrame:
    """(word, row...) for rows whose token list contains a keyword.

    ``keywords`` is a small array column (e.g. :func:`top_word_array`); each row
    emits only the keywords it contains, once per row.
    """
    hit = F.array_intersect(F.array_distinct(F.col(tokens)), keywords)
    return df.select(*keep, F.explode(hit).alias("word"))


def lexicon_table(spark: SparkSession, lexicon=LEXICON) -> DataFrame:
    schema = T.StructType([T.StructField("word", T.StringType(), False),
                           T.StructField("valence", T.DoubleType(), False)])
    return spark.createDataFrame(list(lexicon), schema)


MAX_INLINE_LEXICON = 1000


def lexicon_score(df: DataFrame, key: str, text: Column | str, lexicon,
                  alpha: float = SENTIMENT_ALPHA) -> DataFrame:
    """Compound score in [-1, 1]: sum of word valences s -> s / sqrt(s^2 + alpha).

    ``lexicon``: pairs (word, valence), or a table of them. Up to
    ``MAX_INLINE_LEXICON`` pairs are looked up in the row itself. A table is joined to
    the exploded words and summed per row key (broadcast only if its count is small).
    Rows without any lexicon word score 0.
    """
    text = F.col(text) if isinstance(text, str) else text
    if not isinstance(lexicon, DataFrame):
        pairs = dict(lexicon)
        if len(pairs) <= MAX_INLINE_LEXICON:
            table = F.create_map(*[F.lit(x) for w, v in pairs.items() for x in (w, float(v))])
            s = F.aggregate(F.split(text, r"(?U)\s+"), F.lit(0.0), lambda a, w: a + F.coalesce(table[w], F.lit(0.0)))
            return df.withColumn("_s", s).withColumn("score", F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + F.lit(alpha))).drop("_s")
        lexicon = lexicon_table(df.sparkSession, lexicon)
    words = df.select(F.col(key), F.explode(F.split(text, r"(?U)\s+")).alias("word"))
    hits = attach(words, lexicon, ["word"]).groupBy(key).agg(F.sum("valence").alias("_s"))
    out = df.join(hits, key, "left")
    s = F.coalesce(F.col("_s"), F.lit(0.0))
    return out.withColumn("score", s / F.sqrt(s * s + F.lit(alpha))).drop("_s")


# VADER-style factor of a negated word, and how many words back a negation counts.
NEGATED, NEGATION_REACH = -0.74, 3


def plain_words(c: Column | str) -> Column:
    """Lower-case runs of a to z; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z]+"), F.lit(0))


def context_score(df: DataFrame, key: str, words: str, lexicon: DataFrame, negations: Sequence[str], boosters: dict[str, float],
                  alpha: float = SENTIMENT_ALPHA) -> DataFrame:
    """G4 with word context: (key, score) of rows (key, words: array). A lexicon word's valence grows by
    the intensifier right before it (away from 0) and is turned by a negation among the three words
    before it. Context is read inside the row; the table ``lexicon`` (word, valence) is attached to
    the words, so the rows are only dealt by their own key."""
    strength = F.create_map(*[F.lit(x) for w, b in boosters.items() for x in (w, float(b))])

    def marked(w: Column, i: Column) -> Column:
        before = F.slice(F.col(words), F.greatest(i - NEGATION_REACH + 1, F.lit(1)), F.least(i, F.lit(NEGATION_REACH)))
        return F.struct(w.alias("word"), F.exists(before, lambda x: x.isin(list(negations))).alias("negated"),
                        F.when(i > 0, F.coalesce(strength[F.get(F.col(words), i - 1)], F.lit(0.0))).otherwise(0.0).alias("boost"))

    hits = attach(df.select(key, F.inline(F.transform(words, marked))), lexicon, ["word"])
    valence = (F.col("valence") + F.signum("valence") * F.col("boost")) * F.when(F.col("negated"), NEGATED).otherwise(1.0)
    sums = hits.groupBy(key).agg(F.sum(valence).alias("_s"))
    s = F.coalesce(F.col("_s"), F.lit(0.0))
    return df.select(key).join(sums, key, "left").select(key, (s / F.sqrt(s * s + F.lit(alpha))).alias("score"))


def label_by_threshold(score: Column | str, pos: float = POSITIVE_AT, neg: float = NEGATIVE_AT) -> Column:
    """>= pos Positive, <= neg Negative, otherwise Neutral."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= pos, "Positive").when(s <= neg, "Negative").otherwise("Neutral")


def ngram_terms(text: Column | str, pattern: str = TFIDF_TOKEN, n_max: int = 2) -> Column:
    """Unigrams then bigrams (space-joined) of regex-extracted lower-case words."""
    text = F.col(text) if isinstance(text, str) else text
    toks = F.regexp_extract_all(F.lower(text), F.lit(pattern), 0)
    terms = toks
    if n_max >= 2:
        m = F.greatest(F.size(toks) - 1, F.lit(0))
        bigrams = F.zip_with(F.slice(toks, 1, m), F.slice(toks, 2, m),
                             lambda a, b: F.concat(a, F.lit(" "), b))
        terms = F.concat(toks, bigrams)
    return terms


def tfidf(df: DataFrame, key: str, text: str, min_df: int = 2, max_features: int = 10000,
          vocab_from: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Sublinear TF-IDF of 1-2-grams with smoothed idf and L2 row norm.

    Returns ``(weights, vocab)``: weights (key, term, weight) and the vocabulary
    (term, idx, df, idf). The vocabulary is fitted on ``vocab_from`` (default: ``df``)
    with ``df >= min_df`` and the ``max_features`` most frequent terms (ties by term);
    that cap bounds the broadcast vocabulary.
    """
    fit = vocab_from if vocab_from is not None else df

    def tf_of(d: DataFrame) -> DataFrame:
        return (d.select(key, F.explode(ngram_terms(text)).alias("term"))
                .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))

    tf_fit = tf_of(fit)
    n_docs = fit.select(F.count(F.lit(1))).scalar()
    stats = tf_fit.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tfs"))
    stats = stats.where(F.col("df") >= min_df)
    top = stats.orderBy(F.desc("tfs"), F.col("term")).limit(max_features)
    vocab = (top.withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)
             .withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)
             .select("term", "idx", "df", "idf"))
    tf = tf_fit if vocab_from is None else tf_of(df)
    w = tf.join(F.broadcast(vocab.select("term", "idf")), "term") \
          .select(key, "term", ((1.0 + F.log(F.col("tf"))) * F.col("idf")).alias("_w"))
    norms = w.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"))
    out = w.join(norms, key).select(key, "term", (F.col("_w") / F.col("_norm")).alias("weight"))
    return out, vocab


def _report_row(name: str, p: str, r: str, f: str) -> Column:
    return F.struct(F.lit(name).alias("label"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                    F.col(f).alias("f1"), F.col("_n").cast("long").alias("support"))


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Precision, recall, F1, support per class; accuracy; macro and weighted means.

    One grouped count of (y, yhat) pairs -- a table of at most classes^2 rows -- and
    arithmetic on it; precision with no predictions of a class is 0.
    """
    pairs = df.groupBy(y, yhat).agg(F.count(F.lit(1)).alias("_c"))
    support = pairs.groupBy(F.col(y).alias("label")).agg(F.sum("_c").alias("support"))
    predicted = pairs.groupBy(F.col(yhat).alias("label")).agg(F.sum("_c").alias("_pred"))
    tp = pairs.where(F.col(y) == F.col(yhat)).select(F.col(y).alias("label"), F.col("_c").alias("_tp"))
    per = (support.join(predicted, "label", "full").join(tp, "label", "left")
           .na.fill(0, ["support", "_pred", "_tp"]))
    prec = F.when(F.col("_pred") > 0, F.col("_tp") / F.col("_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("_tp") / F.col("support")).otherwise(0.0)
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.withColumn("f1", f1).select("label", "precision", "recall", "f1",
                                          F.col("support").cast("long").alias("support"), "_tp")
    tot = per.agg(F.sum("support").alias("_n"), F.sum("_tp").alias("_tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("_tp") / F.col("_n")).alias("f1"),
                 F.col("_n").cast("long").alias("support")),
        _report_row("macro avg", "mp", "mr", "mf"),
        _report_row("weighted avg", "wp", "wr", "wf"))))
    return per.drop("_tp").unionByName(summary)
