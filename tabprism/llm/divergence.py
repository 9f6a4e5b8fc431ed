"""Quality rules by distribution divergence, in DataFrame and SQL functions only.

Base rules: too few words, or too many words inside 8-word windows that the text holds
twice or more. Then each document is compared with its language's reference, gathered
from all documents of that language: Jensen-Shannon distance (base 2) between
 * character-class histograms (lower, upper, symbol, space, all others);
 * common-word histograms (every word, as it is written, with at least ``COMMON_SHARE``
   of the language's words is a bin, all others share one).
A short text strays from its reference by chance, in proportion to 1/sqrt(words), so each
limit is ``floor + slope / sqrt(n_words)``. That term alone guards short texts: the word
histogram is not judged below ``MIN_WORDS_FOR_WORDS`` words, but this is ``MIN_WORDS``, below
which the base rules fail a text anyway, and the character histogram is judged from one word
on. ``MIN_WORDS_FOR_WORDS`` was lowered from 50 by counts over labelled documents (README).
A language with fewer than ``MIN_REFERENCE_WORDS`` words in the corpus judges nothing.

Common words are found exactly without shuffling every distinct word: a word with the
share s sits in a hash bucket with at least the share s, and at most 1/s buckets per
language have that; only words of such buckets are counted one by one.

Defined results: null text has no words and fails the base rules; a null language is a
language of its own; ids may be null or repeated (each row is judged by itself); an
empty table gives an empty result; other columns are ignored or passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import checkpoint

SPACE = r"[\x20\x09-\x0D]+"
TRIM = " \t\n\x0b\x0c\r"
CLASSES = {"symbol": r"[#*$%&|<>]+", "lower": r"\p{Ll}+", "upper": r"\p{Lu}+"}
BINS = [*CLASSES, "space", "other"]

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
COMMON_SHARE = 0.002
BUCKETS = 8192
MIN_WORDS_FOR_WORDS = 20
MIN_REFERENCE_WORDS = 1000
CHAR_LIMIT = (0.17, 0.9)
WORD_LIMIT = (0.20, 1.6)
MAX_BROADCAST_LANGUAGES = 2000


def _words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text."""
    bare = F.btrim(text, F.lit(TRIM))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE, -1))


def _char_counts(text: Column, word_chars: Column) -> dict[str, Column]:
    """Code points per class; runs are cut out, so each class is one scan."""
    total = F.length(text)
    counts = {name: total - F.length(F.regexp_replace(text, run, "")) for name, run in CLASSES.items()}
    counts["space"] = total - word_chars
    return counts


def _shifted(array: str, back: bool) -> str:
    """SQL for the array moved by one place, null at the free end."""
    if back:
        return f"concat(array(null), slice({array}, 1, greatest(size({array}) - 1, 0)))"
    return f"concat(slice({array}, 2, greatest(size({array}) - 1, 0)), array(null))"


def _with_base(df: DataFrame) -> DataFrame:
    """Adds the base figures to rows with ``__text`` (not null)."""
    own = df.withColumn("__words", _words(F.col("__text"))).withColumn("n_words", F.size("__words").cast("long"))
    # Hashes of 1, 2, 4 and 8 words in a row, each made of two of the former.
    own = own.withColumn("__w1", F.when(F.col("n_words") >= WINDOW, F.transform("__words", lambda w: F.xxhash64(w))))
    for n in (1, 2, 4):
        left = f"size(__w{n}) - {n}"
        own = own.withColumn(f"__w{2 * n}", F.expr(
            f"zip_with(slice(__w{n}, 1, {left}), slice(__w{n}, {n + 1}, {left}), (a, b) -> xxhash64(a, b))"))
    own = own.withColumnRenamed(f"__w{WINDOW}", "__hashes").drop("__w1", "__w2", "__w4")
    # Sorted (hash, position) pairs, only where some window repeats at all.
    own = own.withColumn("__pairs", F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), F.expr(
        "sort_array(transform(__hashes, (h, i) -> struct(h, i)))")))
    own = own.withColumn("__twice", F.expr(f"""
        zip_with(zip_with(__pairs, {_shifted('__pairs', True)}, (a, b) -> struct(a.h AS h, a.i AS i, a.h <=> b.h AS seen)),
                 {_shifted('__pairs', False)}, (a, b) -> if(a.seen OR a.h <=> b.h, a.i, null))"""))
    own = own.withColumn("__at", F.expr("sort_array(filter(__twice, i -> i IS NOT NULL))"))
    # Windows at a and at the next place b cover min(8, b - a) words that only a's window adds.
    own = own.withColumn("n_repeat_words", F.coalesce(F.expr(f"""
        aggregate(zip_with(__at, {_shifted('__at', False)}, (a, b) -> coalesce(least({WINDOW}, b - a), {WINDOW})), 0L, (n, x) -> n + x)"""), F.lit(0).cast("long")))
    own = own.withColumn("word_chars", F.length(F.array_join("__words", "")).cast("long"))
    lines = F.filter(F.split("__text", "\n", -1), lambda x: F.btrim(x, F.lit(TRIM)) != "")
    own = own.withColumn("__lines", lines)
    own = own.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    for name, count in _char_counts(F.col("__text"), F.col("word_chars")).items():
        own = own.withColumn(f"__{name}", count)
    own = own.withColumn("n_symbols", F.col("__symbol").cast("long"))
    rest = sum((F.col(f"__{b}") for b in BINS if b != "other"), F.lit(0))
    own = own.withColumn("__other", F.length("__text") - rest)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return own.withColumn("base_failed", failed).drop("__hashes", "__pairs", "__twice", "__at", "__lines")


def common_words(df: DataFrame) -> DataFrame:
    """One row per language of rows (__lang, __text): ``total`` words, the map ``common``
    of its common words and their shares, and the ``longest`` of them."""
    words = df.select("__lang", F.explode(_words(F.col("__text"))).alias("w"))
    words = words.withColumn("bucket", F.pmod(F.xxhash64("w"), F.lit(BUCKETS)))
    buckets = checkpoint(words.groupBy("__lang", "bucket").count())
    totals = checkpoint(buckets.groupBy("__lang").agg(F.sum("count").alias("total")))
    few = totals.count() <= MAX_BROADCAST_LANGUAGES
    small = F.broadcast if few else lambda table: table
    same = F.col("b.__lang").eqNullSafe(F.col("t.__lang"))
    heavy = small(buckets.alias("b").join(small(totals.alias("t")), same)
                  .where(F.col("count") >= COMMON_SHARE * F.col("total"))  # at most 1 / COMMON_SHARE rows a language
                  .select(F.col("b.__lang").alias("hl"), F.col("bucket").alias("hb")))
    counted = (words.join(heavy, F.col("__lang").eqNullSafe(F.col("hl")) & (F.col("bucket") == F.col("hb")), "leftsemi")
               .groupBy("__lang", "w").count())
    shares = (counted.alias("b").join(small(totals.alias("t")), same).where(F.col("count") >= COMMON_SHARE * F.col("total"))
              .select(F.col("b.__lang").alias("cl"), "w", (F.col("count") / F.col("total")).alias("q")))
    common = shares.groupBy("cl").agg(F.map_from_entries(F.collect_list(F.struct("w", "q"))).alias("common"), F.max(F.length("w")).alias("longest"))
    return checkpoint(totals.join(common, F.col("__lang").eqNullSafe(F.col("cl")), "left").select(
        F.col("__lang").alias("ref_lang"), "total", F.coalesce("common", F.create_map().cast("map<string,double>")).alias("common"),
        F.coalesce("longest", F.lit(0)).alias("longest")))


def _term(p: Column, q: Column) -> Column:
    """A bin's share of the squared distance, both sides, for p > 0."""
    m = p + q
    return p * F.log2(2 * p / m) + F.when(q > 0, q * F.log2(2 * q / m)).otherwise(0.0)


def class_sums(rows: DataFrame) -> DataFrame:
    """Code points per class and language of rows (__lang, __text); one row a language."""
    counted = rows.withColumn("__space", F.length("__text") - F.length(F.regexp_replace("__text", SPACE, "")))
    for name, count in _char_counts(F.col("__text"), F.length("__text") - F.col("__space")).items():
        counted = counted.withColumn(f"__{name}", count)
    rest = sum((F.col(f"__{b}") for b in BINS if b != "other"), F.lit(0))
    return checkpoint(_summed(counted.withColumn("__other", F.length("__text") - rest)))


def _summed(counted: DataFrame) -> DataFrame:
    return counted.groupBy(F.col("__lang").alias("ref_lang")).agg(*[F.sum(f"__{b}").alias(f"__{b}_all") for b in BINS])


def judge(df: DataFrame, lang_col: str, text_col: str, kept_cols: list[str], wide: bool = False) -> DataFrame:
    """The named columns of ``df`` as struct ``__row``, the figures, both distances and the
    verdict, one row per row. The class histograms of the languages need all texts: either
    the rows are kept meanwhile with their figures, or (``wide``: the rows hold the texts) the
    classes are counted in a pass of their own, so that no text is kept."""
    rows = df.select(F.struct(*[F.col(f"`{n}`") for n in kept_cols]).alias("__row"), F.col(lang_col).alias("__lang"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    refs = common_words(rows.select("__lang", "__text"))
    few = refs.count() <= MAX_BROADCAST_LANGUAGES
    small = F.broadcast if few else lambda table: table
    own = _with_base(rows.join(small(refs), F.col("__lang").eqNullSafe(F.col("ref_lang")), "left"))
    # Words that are common ones, sorted; the length of a run is that word's count.
    own = own.withColumn("__known", F.expr("sort_array(filter(__words, w -> length(w) <= longest AND map_contains_key(common, w)))"))
    own = own.withColumn("__last", F.expr(f"zip_with(__known, {_shifted('__known', False)}, (a, b) -> if(a <=> b, null, a))"))
    own = own.withColumn("__runs", F.expr("filter(transform(__last, (w, i) -> struct(w, i)), r -> r.w IS NOT NULL)"))
    own = own.withColumn("__bins", F.expr("""
        zip_with(__runs, concat(array(-1), transform(slice(__runs, 1, greatest(size(__runs) - 1, 0)), r -> r.i)),
                 (r, before) -> if(r IS NULL, null, struct((r.i - before) / n_words AS p, common[r.w] AS q)))"""))
    own = own.withColumn("__bins", F.filter("__bins", lambda b: b.isNotNull()))
    own = own.withColumn("__sums", F.aggregate("__bins", F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q")), lambda s, b: F.struct(
        (s["d"] + _term(b["p"], b["q"])).alias("d"), (s["p"] + b["p"]).alias("p"), (s["q"] + b["q"]).alias("q"))))
    own = own.withColumn("__q", F.expr("aggregate(map_values(common), 0D, (s, x) -> s + x)"))
    p_other, q_other = 1 - F.col("__sums.p"), F.greatest(1 - F.col("__q"), F.lit(0.0))
    other = F.when(p_other > 1e-12, _term(p_other, q_other)).otherwise(q_other)
    own = own.withColumn("__word_sum", F.col("__sums.d") + (F.col("__q") - F.col("__sums.q")) + other)
    counts = [f"__{b}" for b in BINS]
    own = own.select("__row", "__lang", "total", "__word_sum", *FIGURES, *counts)
    if not wide:
        own = checkpoint(own)

    chars = sum((F.col(c) for c in counts), F.lit(0))
    refs = class_sums(rows.select("__lang", "__text")) if wide else _summed(own)
    own = own.join(small(refs), F.col("__lang").eqNullSafe(F.col("ref_lang")))
    all_chars = F.greatest(sum((F.col(f"{c}_all") for c in counts), F.lit(0)), F.lit(1))
    char_sum = F.lit(0.0)
    for c in counts:
        p, q = F.col(c) / F.greatest(chars, F.lit(1)), F.col(f"{c}_all") / all_chars
        char_sum = char_sum + F.when(p > 0, _term(p, q)).otherwise(q)
    distance = lambda s: F.round(F.sqrt(F.greatest(s / 2, F.lit(0.0))), 6)
    judged = F.col("total") >= MIN_REFERENCE_WORDS
    own = own.withColumn("char_distance", F.when(judged & (F.col("n_words") > 0), distance(char_sum)))
    own = own.withColumn("word_distance", F.when(judged & (F.col("n_words") >= MIN_WORDS_FOR_WORDS), distance(F.col("__word_sum"))))
    limit = lambda pair: pair[0] + pair[1] / F.sqrt(F.greatest("n_words", F.lit(1)))
    strays = [F.coalesce(F.col(c) > limit(x), F.lit(False)) for c, x in (("char_distance", CHAR_LIMIT), ("word_distance", WORD_LIMIT))]
    return own.withColumn("kept", ~(F.col("base_failed") | strays[0] | strays[1])).select("__row", *FIGURES, "kept", "char_distance", "word_distance")


def quality(df: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the figures, the distances and the verdict."""
    return judge(df, lang_col, text_col, [id_col]).select(f"__row.{id_col}", *FIGURES, "kept", "char_distance", "word_distance")


def keep_good(df: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` that the rules keep, with its own columns."""
    # The number keeps the filter above the projection: below it the figures would be spelled out again in the condition.
    judged = judge(df, lang_col, text_col, df.columns, wide=True).select("__row", "kept", F.monotonically_increasing_id().alias("__number"))
    return judged.where("kept AND __number >= 0").select(*[F.col(f"__row.`{n}`").alias(n) for n in df.columns])
