"""Profiling queries (sections 2A-2F) over the portable listings view.

Every query reads the whole driver tables through :func:`listings`; doubles are
rounded to 6 decimals on both sides so engine-level last-bit differences of ``ln``
and ``exp`` do not change the value hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprism.functions.binning import (AMENITY_BINS, PRICE_BINS_8, TENURE_BINS, bin_table,
                                        case_sql_left_closed, case_sql_right_closed,
                                        right_closed_bin, values_sql)
from tabprism.functions.scalar import (CATEGORICAL_FEATURES, NUMERICAL_FEATURES, adaptive_price,
                                       fill_zero, list_size, normalise_text, parse_percent,
                                       price_from_log, round_doubles, select_features,
                                       tenure_years)
from tabprism.operators import bins as B
from tabprism.operators import stats as S
from tabprism.operators.attach import attach
from tabprism.operators.quantiles import exact_quantiles
from tabprism.operators.sampling import sample_exact
from tabprism.plans.registry import query
from tabprism.session import cut_lineage, ensure_checkpoint_dir
from tabprism.sources.io import LISTINGS_SCHEMA, read_listings, write_listings_csv
from tabprism.sources.listings import (LISTING_COLUMNS, listings, listings_clean,
                                       oracle_with)

W = oracle_with()
DOUBLE_COLS = {"log_price", *NUMERICAL_FEATURES}
PRICE_SQL = "CASE WHEN (SELECT max(log_price) FROM lc) < 20 THEN exp(log_price) ELSE log_price END"
TENURE_SQL = "date_diff('day', TRY_CAST(host_since AS DATE), DATE '2024-01-01') / 365.0"
AMENITY_SQL = "CAST(len(string_split(amenities, ',')) AS INTEGER)"
SAMPLE_ORDER_SQL = "md5(CAST(listing_id AS VARCHAR) || '|42'), listing_id"


def _r(c: str, d: int = 6) -> str:
    return f"round({c}, {d})"


# ---------------------------------------------------------------- 2A scans
@query("listings_scan", "A1", oracle=W + "SELECT " + ", ".join(
    (_r(a) + f" AS {a}") if a in DOUBLE_COLS else a for a, _ in LISTING_COLUMNS) + " FROM listings")
def listings_scan(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(listings(spark, sf, text=True))


@query("listings_csv_scan", "A1", oracle=W + "SELECT " + ", ".join(
    (_r(a) + f" AS {a}") if a in DOUBLE_COLS else a for a, _ in LISTING_COLUMNS if a != "description") + " FROM listings")
def listings_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The listings written as CSV to the shared folder and read back with the schema."""
    rows = listings(spark, sf, text=("name",))
    path = f"{ensure_checkpoint_dir(spark)}/listings-csv-{uuid.uuid4().hex}"
    write_listings_csv(rows, path)
    schema = T.StructType([f for n in rows.columns for f in LISTINGS_SCHEMA if f.name == n])
    return round_doubles(read_listings(spark, path, schema=schema, multi_line=False))


@query("target_clean", "A2", oracle=W + "SELECT listing_id, round(log_price, 6) AS log_price FROM lc")
def target_clean(spark, sf):
    return round_doubles(listings_clean(spark, sf).select("listing_id", "log_price"))


@query("percent_parse", "A3", oracle=W + """SELECT listing_id, host_response_rate,
  TRY_CAST(replace(host_response_rate, '%', '') AS DOUBLE) AS host_response_rate_pct FROM listings""")
def percent_parse(spark, sf):
    return listings(spark, sf).select("listing_id", "host_response_rate",
                                      parse_percent("host_response_rate").alias("host_response_rate_pct"))


@query("feature_select", "A4", oracle=W + "SELECT listing_id, " + ", ".join(
    [_r(c) + f" AS {c}" for c in NUMERICAL_FEATURES] + CATEGORICAL_FEATURES
    + ["round(log_price, 6) AS log_price"]) + " FROM lc")
def feature_select(spark, sf):
    return round_doubles(select_features(listings_clean(spark, sf)))


# ---------------------------------------------------------------- 2B scalar
@query("price_from_log", "B1", oracle=W + "SELECT listing_id, round(exp(log_price), 6) AS price FROM lc")
def q_price_from_log(spark, sf):
    return round_doubles(listings_clean(spark, sf).select("listing_id", price_from_log().alias("price")))


@query("log1p_target", "B2", oracle=W + "SELECT listing_id, round(ln(1 + log_price), 6) AS log1p_target FROM lc")
def q_log1p(spark, sf):
    return round_doubles(listings_clean(spark, sf).select("listing_id", F.log1p("log_price").alias("log1p_target")))


@query("adaptive_price", "B3", oracle=W + f"SELECT listing_id, round({PRICE_SQL}, 6) AS price FROM lc")
def q_adaptive_price(spark, sf):
    lc = listings_clean(spark, sf)
    return round_doubles(lc.select("listing_id", adaptive_price(lc).alias("price")))


@query("dropna_subset", "B4", oracle=W + """SELECT listing_id, host_since, round(review_scores_rating, 6)
  AS review_scores_rating, round(log_price, 6) AS log_price FROM listings
  WHERE host_since IS NOT NULL AND review_scores_rating IS NOT NULL AND log_price IS NOT NULL""")
def q_dropna(spark, sf):
    df = listings(spark, sf).select("listing_id", "host_since", "review_scores_rating", "log_price")
    return round_doubles(df.dropna(subset=["host_since", "review_scores_rating", "log_price"]))


@query("range_filter", "B5", oracle=W + f"""SELECT listing_id, round({TENURE_SQL}, 6) AS tenure_years,
  {AMENITY_SQL} AS amenity_count FROM lc
  WHERE {TENURE_SQL} BETWEEN 0 AND 20 AND {AMENITY_SQL} > 0""")
def q_range_filter(spark, sf):
    df = listings_clean(spark, sf).select("listing_id", tenure_years().alias("tenure_years"),
                                          list_size("amenities").alias("amenity_count"))
    return round_doubles(df.where(F.col("tenure_years").between(0, 20) & (F.col("amenity_count") > 0)))


@query("label_filter", "B6", oracle=W + """SELECT listing_id, room_type,
  CAST(room_type = 'F' AS INTEGER) AS label_enc FROM lc WHERE room_type IN ('F', 'O')""")
def q_label_filter(spark, sf):
    df = listings_clean(spark, sf).where(F.col("room_type").isin("F", "O"))
    return df.select("listing_id", "room_type", (F.col("room_type") == "F").cast("int").alias("label_enc"))


@query("clip_p99", "B7", oracle=W + f"""
, p AS (SELECT listing_id, city, {PRICE_SQL} AS price FROM lc),
  g AS (SELECT quantile_cont(price, 0.99) AS p99 FROM p),
  c AS (SELECT city, quantile_cont(price, 0.99) AS p99c FROM p GROUP BY city)
SELECT p.listing_id, p.city, round(least(p.price, g.p99), 8) AS price_clip_global,
       round(least(p.price, c.p99c), 8) AS price_clip_city
FROM p, g, c WHERE c.city = p.city""".replace("\n, p AS", ", p AS", 1))
def q_clip_p99(spark, sf):
    lc = listings_clean(spark, sf)
    p = lc.select("listing_id", "city", adaptive_price(lc).alias("price"))
    p99 = exact_quantiles(p, "price", [0.99], names=["p99"]).select("p99").scalar()
    p99c = exact_quantiles(p, "price", [0.99], ["city"], ["p99c"]).drop("n")
    out = attach(p, p99c, ["city"]).select(
        "listing_id", "city", F.least("price", p99).alias("price_clip_global"),
        F.least("price", "p99c").alias("price_clip_city"))
    return round_doubles(out, 8)


@query("zscore_outliers", "B8", oracle=W + """SELECT listing_id, round(log_price, 6) AS log_price FROM lc
  WHERE abs((log_price - (SELECT avg(log_price) FROM lc)) / (SELECT stddev_pop(log_price) FROM lc)) < 3.5""")
def q_zscore(spark, sf):
    from tabprism.operators.sampling import remove_outliers
    return round_doubles(remove_outliers(listings_clean(spark, sf), "log_price", 3.5).select("listing_id", "log_price"))


@query("fill_zero", "B9", oracle=W + """SELECT listing_id, coalesce(bathrooms, 0) AS bathrooms,
  coalesce(bedrooms, 0) AS bedrooms, coalesce(beds, 0) AS beds,
  coalesce(review_scores_rating, 0) AS review_scores_rating FROM lc""")
def q_fill_zero(spark, sf):
    lc = listings_clean(spark, sf)
    return lc.select("listing_id", *[fill_zero(c).cast("double").alias(c)
                                     for c in ("bathrooms", "bedrooms", "beds", "review_scores_rating")])


@query("host_tenure_years", "B10", oracle=W + f"""SELECT listing_id, host_since,
  round({TENURE_SQL}, 6) AS tenure_years FROM listings""")
def q_tenure(spark, sf):
    df = listings(spark, sf)
    return round_doubles(df.select("listing_id", "host_since", tenure_years().alias("tenure_years")))


@query("amenity_count", "B11", oracle=W + f"SELECT listing_id, {AMENITY_SQL} AS amenity_count FROM listings")
def q_amenity_count(spark, sf):
    return listings(spark, sf).select("listing_id", list_size("amenities").alias("amenity_count"))


@query("name_normalise", "B12", oracle=W + r"""SELECT listing_id,
  regexp_replace(lower(name), '^\s+|\s+$', '', 'g') AS name_clean FROM listings WHERE name IS NOT NULL""")
def q_name_normalise(spark, sf):
    df = listings(spark, sf, text=True).where(F.col("name").isNotNull())
    return df.select("listing_id", normalise_text("name").alias("name_clean"))


# ---------------------------------------------------------------- 2C bins
_P8 = f"WITH bins8(ord, label, lo, hi) AS ({values_sql(PRICE_BINS_8)})"


def _bucket_oracle() -> str:
    return W.replace("WITH ", f"{_P8}, ", 1) + f"""
, b AS (SELECT {case_sql_right_closed('price', PRICE_BINS_8)} AS ord
        FROM (SELECT {PRICE_SQL} AS price FROM lc) t),
  c AS (SELECT ord, count(*) AS n FROM b WHERE ord IS NOT NULL GROUP BY ord)
SELECT bins8.ord, bins8.label, coalesce(c.n, 0) AS n,
  round(coalesce(c.n, 0) * 100.0 / sum(coalesce(c.n, 0)) OVER (), 6) AS share
FROM bins8 LEFT JOIN c ON c.ord = bins8.ord""".replace("\n, b AS", ", b AS", 1)


@query("price_buckets", "C1", oracle=_bucket_oracle())
def q_price_buckets(spark, sf):
    lc = listings_clean(spark, sf)
    return round_doubles(B.bucket_counts(lc, adaptive_price(lc), PRICE_BINS_8))


@query("bucket_position", "C2", oracle=W + f"""
, p AS (SELECT {PRICE_SQL} AS price FROM lc),
  s AS (SELECT avg(price) AS mean_price, quantile_cont(price, 0.5) AS median_price FROM p)
SELECT round(mean_price, 8) AS mean_price, round(median_price, 8) AS median_price,
  {case_sql_left_closed('mean_price', PRICE_BINS_8)} AS mean_pos,
  {case_sql_left_closed('median_price', PRICE_BINS_8)} AS median_pos FROM s""".replace("\n, p AS", ", p AS", 1))
def q_bucket_position(spark, sf):
    lc = listings_clean(spark, sf)
    p = lc.select(adaptive_price(lc).alias("price"))
    med = exact_quantiles(p, "price", [0.5], names=["median_price"]).select("median_price").scalar()
    s = p.agg(F.avg("price").alias("mean_price")).withColumn("median_price", med)
    out = s.select("mean_price", "median_price",
                   B.bucket_position(F.col("mean_price"), PRICE_BINS_8).alias("mean_pos"),
                   B.bucket_position(F.col("median_price"), PRICE_BINS_8).alias("median_pos"))
    return round_doubles(out, 8)


def _binned_mean_oracle(expr_sql: str, where_sql: str, spec, pre: str) -> str:
    return (W.replace("WITH ", f"WITH bins(ord, label, lo, hi) AS ({values_sql(spec)}), ", 1) + f"""
, t AS (SELECT {case_sql_right_closed('v', spec)} AS ord, log_price
        FROM (SELECT {expr_sql} AS v, log_price FROM lc WHERE {pre}) x WHERE {where_sql})
SELECT t.ord, bins.label, count(*) AS n, round(avg(log_price), 6) AS mean_target
FROM t JOIN bins ON bins.ord = t.ord GROUP BY t.ord, bins.label""").replace("\n, t AS", ", t AS", 1)


@query("host_tenure_price", "C3", oracle=_binned_mean_oracle(TENURE_SQL, "v BETWEEN 0 AND 20", TENURE_BINS, "host_since IS NOT NULL"))
def q_host_tenure(spark, sf):
    df = listings_clean(spark, sf).where(F.col("host_since").isNotNull())
    df = df.withColumn("t", tenure_years()).where(F.col("t").between(0, 20))
    return round_doubles(B.binned_mean(df, "t", TENURE_BINS, "log_price"))


@query("amenity_bins_price", "C4", oracle=_binned_mean_oracle(AMENITY_SQL, "v > 0", AMENITY_BINS, "amenities IS NOT NULL"))
def q_amenity_bins(spark, sf):
    df = listings_clean(spark, sf).where(F.col("amenities").isNotNull())
    df = df.withColumn("a", list_size("amenities")).where(F.col("a") > 0)
    return round_doubles(B.binned_mean(df, "a", AMENITY_BINS, "log_price"))


def _hist_sql(series: str, src: str, bins: int) -> str:
    return f"""SELECT '{series}' AS series, g.bin,
  round(r.lo + g.bin * (r.hi - r.lo) / {float(bins)}, 8) AS bin_lo,
  round(r.lo + (g.bin + 1) * (r.hi - r.lo) / {float(bins)}, 8) AS bin_hi,
  coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g
CROSS JOIN (SELECT min(v) AS lo, max(v) AS hi FROM {src}) r
LEFT JOIN (SELECT CAST(CASE WHEN r2.hi = r2.lo THEN 0 ELSE least(floor((v - r2.lo) / ((r2.hi - r2.lo) / {float(bins)})), {bins - 1}) END AS INTEGER) AS bin,
             count(*) AS n
           FROM {src}, (SELECT min(v) AS lo, max(v) AS hi FROM {src}) r2 GROUP BY 1) c ON c.bin = g.bin"""


_HIST_SOURCES = f"""
, h_log AS (SELECT log_price AS v FROM lc),
  h_price AS (SELECT least(p, (SELECT quantile_cont(p, 0.99) FROM (SELECT {PRICE_SQL} AS p FROM lc) q)) AS v
              FROM (SELECT {PRICE_SQL} AS p FROM lc) q2),
  h_avail AS (SELECT CAST(availability_365 AS DOUBLE) AS v FROM lc WHERE availability_365 IS NOT NULL),
  h_l1p AS (SELECT ln(1 + log_price) AS v FROM lc)
""".replace("\n, h_log", ", h_log", 1)


@query("histogram", "C5", oracle=W + _HIST_SOURCES + "\nUNION ALL\n".join([
    _hist_sql("log_price", "h_log", 60), _hist_sql("price_clipped", "h_price", 60),
    _hist_sql("availability_365", "h_avail", 50), _hist_sql("log1p_target", "h_l1p", 80)]))
def q_histogram(spark, sf):
    # four series over the same rows: materialize the narrow value columns once
    lc = cut_lineage(listings_clean(spark, sf).select("log_price", "availability_365"))
    price = lc.select(adaptive_price(lc).alias("p"))
    p99 = exact_quantiles(price, "p", [0.99], names=["p99"]).select("p99").scalar()
    parts = [
        ("log_price", lc.select(F.col("log_price").alias("v")), 60),
        ("price_clipped", price.select(F.least("p", p99).alias("v")), 60),
        ("availability_365", lc.select(F.col("availability_365").cast("double").alias("v")), 50),
        ("log1p_target", lc.select(F.log1p("log_price").alias("v")), 80),
    ]
    out = None
    for name, d, nb in parts:
        h = B.histogram(d, "v", nb).select(F.lit(name).alias("series"), "*")
        out = h if out is None else out.unionByName(h)
    return round_doubles(out, 8)


@query("histogram_target", "C5", oracle=W + ", h_raw AS (SELECT log_price AS v FROM listings WHERE log_price IS NOT NULL)\n"
       + _hist_sql("target", "h_raw", 80))
def q_histogram_target(spark, sf):
    """80 bins of the raw target, before cleaning."""
    raw = listings(spark, sf).select(F.col("log_price").alias("v"))
    return round_doubles(B.histogram(raw, "v", 80).select(F.lit("target").alias("series"), "*"), 8)


_HEX_NX, _HEX_NY = 40, 23


@query("hexbin_mean", "C7", oracle=W + f"""
, d AS (SELECT longitude AS x, latitude AS y, log_price AS c FROM lc
        WHERE longitude IS NOT NULL AND latitude IS NOT NULL),
  e AS (SELECT min(x) AS x0r, max(x) AS x1r, min(y) AS y0r, max(y) AS y1r FROM d),
  e2 AS (SELECT CASE WHEN x1r = x0r THEN x0r - 0.1 ELSE x0r END AS x0a,
                CASE WHEN x1r = x0r THEN x1r + 0.1 ELSE x1r END AS x1a,
                CASE WHEN y1r = y0r THEN y0r - 0.1 ELSE y0r END AS y0,
                CASE WHEN y1r = y0r THEN y1r + 0.1 ELSE y1r END AS y1 FROM e),
  e3 AS (SELECT x0a - 1e-9 * (x1a - x0a) AS x0, x1a + 1e-9 * (x1a - x0a) AS x1, y0, y1 FROM e2),
  e4 AS (SELECT x0, y0, (x1 - x0) / {float(_HEX_NX)} AS sx, (y1 - y0) / {float(_HEX_NY)} AS sy FROM e3),
  p AS (SELECT (x - x0) / sx AS ix, (y - y0) / sy AS iy, c FROM d, e4),
  q AS (SELECT ix, iy, c, round_even(ix, 0) AS ix1, round_even(iy, 0) AS iy1, floor(ix) AS ix2, floor(iy) AS iy2 FROM p),
  r AS (SELECT CASE WHEN pow(ix - ix1, 2) + 3.0 * pow(iy - iy1, 2) < pow(ix - ix2 - 0.5, 2) + 3.0 * pow(iy - iy2 - 0.5, 2)
                    THEN 1 ELSE 2 END AS lattice, ix1, iy1, ix2, iy2, c FROM q),
  s AS (SELECT lattice, CAST(CASE WHEN lattice = 1 THEN ix1 ELSE ix2 END AS INTEGER) AS i,
               CAST(CASE WHEN lattice = 1 THEN iy1 ELSE iy2 END AS INTEGER) AS j, c FROM r)
SELECT lattice, i, j,
  round(x0 + (i + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * sx, 6) AS center_x,
  round(y0 + (j + CASE WHEN lattice = 2 THEN 0.5 ELSE 0.0 END) * sy, 6) AS center_y,
  count(*) AS n, round(avg(c), 6) AS mean_value
FROM s, e4 GROUP BY lattice, i, j, x0, y0, sx, sy""".replace("\n, d AS", ", d AS", 1))
def q_hexbin(spark, sf):
    lc = listings_clean(spark, sf)
    return round_doubles(B.hexbin_mean(lc, "longitude", "latitude", "log_price", _HEX_NX))


@query("domain_reindex", "F1", oracle=(W.replace("WITH ", f"WITH bins(ord, label, lo, hi) AS ({values_sql(AMENITY_BINS)}), ", 1) + f"""
, c AS (SELECT {case_sql_right_closed(AMENITY_SQL, AMENITY_BINS)} AS ord, count(*) AS n FROM lc GROUP BY 1)
SELECT bins.ord, bins.label, coalesce(c.n, 0) AS n FROM bins LEFT JOIN c ON c.ord = bins.ord""").replace("\n, c AS", ", c AS", 1))
def q_domain_reindex(spark, sf):
    lc = listings_clean(spark, sf)
    counts = (lc.select(F.coalesce(right_closed_bin(list_size("amenities"), AMENITY_BINS), F.lit(0)).alias("ord"))
              .groupBy("ord").agg(F.count(F.lit(1)).alias("n")))  # ordinal 0, out of range, has no label
    return B.reindex_counts(counts, AMENITY_BINS).select("ord", "label", "n")


# ---------------------------------------------------------------- 2D aggregates
_DESC_COLS = NUMERICAL_FEATURES + ["log_price"]


def _long_sql(cols, src="lc", ids=""):
    return "\nUNION ALL\n".join(
        f"SELECT {ids}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src} WHERE {c} IS NOT NULL" for c in cols)


@query("describe_numeric", "D1", oracle=W + f"""
, l AS ({_long_sql(_DESC_COLS)})
SELECT feature, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(max(value), 6) AS max FROM l GROUP BY feature""".replace("\n, l AS", ", l AS", 1))
def q_describe(spark, sf):
    return round_doubles(S.describe(listings_clean(spark, sf), _DESC_COLS))


def _dist_sql(series, src):
    return f"""SELECT '{series}' AS series, count(v) AS n, round(avg(v), 8) AS mean,
  round(quantile_cont(v, 0.5), 8) AS median, round(stddev_samp(v), 8) AS std,
  round(avg(v) - stddev_samp(v), 8) AS minus_1sd, round(avg(v) + stddev_samp(v), 8) AS plus_1sd,
  round(avg(power(v - (SELECT avg(v) FROM {src}), 3)) / power(var_pop(v), 1.5), 8) AS skew,
  round(avg(power(v - (SELECT avg(v) FROM {src}), 4)) / power(var_pop(v), 2) - 3, 8) AS kurt FROM {src}"""


@query("distribution_stats", "D2", oracle=W + _HIST_SOURCES + _dist_sql("log_price", "h_log")
       + "\nUNION ALL\n" + _dist_sql("price_clipped", "h_price"))
def q_distribution(spark, sf):
    lc = cut_lineage(listings_clean(spark, sf).select("log_price"))
    price = lc.select(adaptive_price(lc).alias("p"))
    p99 = exact_quantiles(price, "p", [0.99], names=["p99"]).select("p99").scalar()
    a = S.distribution_stats(lc.select(F.col("log_price").alias("v")), "v")
    b = S.distribution_stats(price.select(F.least("p", p99).alias("v")), "v")
    out = a.select(F.lit("log_price").alias("series"), "*").unionByName(
        b.select(F.lit("price_clipped").alias("series"), "*"))
    return round_doubles(out, 8)


def _band_sql(series, expr):
    return f"""SELECT '{series}' AS series, round(quantile_cont(v, 0.05), 8) AS p05,
  round(quantile_cont(v, 0.95), 8) AS p95, round(quantile_cont(v, 0.99), 8) AS p99,
  round(max(v), 8) AS max FROM (SELECT {expr} AS v FROM lc) t"""


@query("percentile_band", "D3", oracle=W + _band_sql("log_price", "log_price") + "\nUNION ALL\n"
       + _band_sql("price", PRICE_SQL))
def q_percentile_band(spark, sf):
    lc = listings_clean(spark, sf)
    out = None
    for name, col in (("log_price", F.col("log_price")), ("price", adaptive_price(lc))):
        d = lc.select(col.alias("v"))
        q = exact_quantiles(d, "v", [0.05, 0.95, 0.99], names=["p05", "p95", "p99"]).drop("n")
        q = q.withColumn("max", d.select(F.max("v")).scalar()).select(F.lit(name).alias("series"), "*")
        out = q if out is None else out.unionByName(q)
    return round_doubles(out, 8)


def _corr_sql():
    cols = _DESC_COLS
    parts = []
    for i in range(len(cols)):
        for j in range(i):
            parts.append(f"SELECT '{cols[i]}' AS col_a, '{cols[j]}' AS col_b, round(corr({cols[i]}, {cols[j]}), 6) AS r FROM lc")
    return "\nUNION ALL\n".join(parts)


@query("correlation_lower", "D4", oracle=W + _corr_sql())
def q_correlation(spark, sf):
    return round_doubles(S.correlations(listings_clean(spark, sf), _DESC_COLS))


_ALL_COLS = [a for a, _ in LISTING_COLUMNS]


@query("missing_fraction", "D5", oracle=W + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_frac FROM lc"
    for c in _ALL_COLS) + ") t WHERE missing_frac > 0")
def q_missing(spark, sf):
    return round_doubles(S.missing_fraction(listings_clean(spark, sf, text=True), _ALL_COLS))


def _box_sql(src, keys):
    k = ", ".join(keys)
    on = " AND ".join(f"d.{x} = q.{x}" for x in keys)
    return f"""
, q AS (SELECT {k}, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM {src} GROUP BY {k}),
  f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT {", ".join("q." + x for x in keys)}, q.n, round(q.q1, 6) AS q1, round(q.median, 6) AS median,
  round(q.q3, 6) AS q3,
  round(min(CASE WHEN d.value >= q.lo THEN d.value END), 6) AS whisker_lo,
  round(max(CASE WHEN d.value <= q.hi THEN d.value END), 6) AS whisker_hi,
  count(CASE WHEN d.value < q.lo OR d.value > q.hi THEN 1 END) AS n_outliers
FROM {src} d JOIN f q ON {on}
GROUP BY {", ".join("q." + x for x in keys)}, q.n, q.q1, q.median, q.q3""".replace("\n, q AS", ", q AS", 1)


@query("box_stats_numeric", "D6", oracle=W + f", l AS ({_long_sql(NUMERICAL_FEATURES)})" + _box_sql("l", ["feature"]))
def q_box_numeric(spark, sf):
    lc = listings_clean(spark, sf)
    lng = S.to_long(lc.select(*NUMERICAL_FEATURES), [], NUMERICAL_FEATURES)
    return round_doubles(S.box_stats(lng, "value", ["feature"]))


_BOX_CATS = CATEGORICAL_FEATURES[:4] + ["cancellation_policy"]


def _cat_long_sql(cats):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {c} AS category, log_price AS value FROM lc WHERE {c} IS NOT NULL" for c in cats)


@query("box_stats_by_category", "D7", oracle=W + f", l AS ({_cat_long_sql(_BOX_CATS)})" + _box_sql("l", ["feature", "category"]))
def q_box_category(spark, sf):
    lc = listings_clean(spark, sf)
    lng = lc.unpivot(["log_price"], _BOX_CATS, "feature", "category").where(F.col("category").isNotNull())
    return round_doubles(S.box_stats(lng.withColumnRenamed("log_price", "value"), "value", ["feature", "category"]))


@query("category_median_order", "D9", oracle=W + f"""
, l AS ({_cat_long_sql(_BOX_CATS)}),
  m AS (SELECT feature, category, quantile_cont(value, 0.5) AS median FROM l GROUP BY feature, category)
SELECT feature, category, round(median, 6) AS median,
  CAST(row_number() OVER (PARTITION BY feature ORDER BY median DESC, category) AS INTEGER) AS rnk FROM m""".replace("\n, l AS", ", l AS", 1))
def q_category_median(spark, sf):
    lc = listings_clean(spark, sf)
    lng = lc.unpivot(["log_price"], _BOX_CATS, "feature", "category").where(F.col("category").isNotNull())
    med = exact_quantiles(lng, "log_price", [0.5], ["feature", "category"], ["median"]).drop("n")
    w = Window.partitionBy("feature").orderBy(F.desc("median"), "category")  # one row per category
    return round_doubles(med.withColumn("rnk", F.row_number().over(w)))


@query("city_centers", "D10", oracle=W + """SELECT city, round(avg(latitude), 6) AS latitude_mean,
  round(avg(longitude), 6) AS longitude_mean FROM lc
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND city IS NOT NULL GROUP BY city""")
def q_city_centers(spark, sf):
    return round_doubles(S.group_mean(listings_clean(spark, sf), "city", ["latitude", "longitude"]))


@query("room_city_pivot", "D11", oracle=W + """
, m AS (SELECT city, room_type, avg(log_price) AS v FROM lc WHERE city IS NOT NULL AND room_type IS NOT NULL
        GROUP BY city, room_type),
  g AS (SELECT max(v) AS gmax FROM m)
SELECT city, round(max(CASE WHEN room_type = 'F' THEN v END), 6) AS room_F,
  round(max(CASE WHEN room_type = 'O' THEN v END), 6) AS room_O,
  round(max(CASE WHEN room_type = 'P' THEN v END), 6) AS room_P,
  bool_or(abs(v - (SELECT gmax FROM g)) < 1e-6) AS has_global_max
FROM m GROUP BY city""".replace("\n, m AS", ", m AS", 1))
def q_room_city(spark, sf):
    return round_doubles(S.pivot_mean(listings_clean(spark, sf), "city", "room_type", "log_price", "room_"))


def _kde_parts(src: str, points: int, by: str | None = None, min_n: int = 0, cut: float = 0.0):
    """(CTE text, final SELECT) of a full rows x grid Gaussian KDE (oracle only)."""
    g = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    on = f"d.{by} = g.{by}" if by else "TRUE"
    key = f"g.{by}, " if by else ""
    ctes = f""", s AS (SELECT {g}count(v) AS n, stddev_samp(v) * pow(count(v), -0.2) AS bw, min(v) AS mn,
               max(v) AS mx FROM {src} {gb}),
  s2 AS (SELECT *, mn - {cut} * bw AS g0, (mx + {cut} * bw - (mn - {cut} * bw)) / {float(points - 1)} AS step
         FROM s WHERE n > {min_n} AND bw > 0),
  g AS (SELECT s2.*, CAST(r.range AS INTEGER) AS i FROM s2, range({points}) r)
"""
    sel = f"""SELECT {key}g.i, round(g.g0 + g.i * g.step, 6) AS x,
  round(sum(exp(-0.5 * pow((g.g0 + g.i * g.step - d.v) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())), 6) AS density
FROM g JOIN {src} d ON {on}
GROUP BY {key}g.i, g.g0, g.step, g.n, g.bw"""
    return ctes, sel


_K1 = _kde_parts("k", 500)


@query("kde", "D12", oracle=W + ", k AS (SELECT log_price AS v FROM lc)\n" + _K1[0] + _K1[1])
def q_kde(spark, sf):
    return round_doubles(S.kde(listings_clean(spark, sf), "log_price", 500))


_K3 = _kde_parts("k", 500)


@query("kde_price_clipped", "D12", oracle=W + f"""
, p AS (SELECT {PRICE_SQL} AS price FROM lc),
  k AS (SELECT least(price, (SELECT quantile_cont(price, 0.99) FROM p)) AS v FROM p)
""".replace("\n, p AS", ", p AS", 1) + _K3[0] + _K3[1])
def q_kde_price_clipped(spark, sf):
    """Density of the price clipped at its 99th percentile."""
    lc = listings_clean(spark, sf)
    price = lc.select(adaptive_price(lc).alias("p"))
    p99 = exact_quantiles(price, "p", [0.99], names=["p99"]).select("p99").scalar()
    return round_doubles(S.kde(price.select(F.least("p", p99).alias("v")), "v", 500))


_K2 = _kde_parts("k", 100, "room_type", 0, 2.0)


@query("violin_by_category", "D8", oracle=W + ", k AS (SELECT room_type, log_price AS v FROM lc WHERE room_type IS NOT NULL)\n"
       + _K2[0] + ", dens AS (" + _K2[1] + """)
, qs AS (SELECT room_type, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
               round(quantile_cont(v, 0.75), 6) AS q3 FROM k GROUP BY room_type)
SELECT dens.*, qs.q1, qs.median, qs.q3 FROM dens JOIN qs ON qs.room_type = dens.room_type""")
def q_violin(spark, sf):
    lc = listings_clean(spark, sf)
    dens = S.kde(lc, "log_price", 100, by=["room_type"], cut=2.0)
    qs = exact_quantiles(lc, "log_price", [0.25, 0.5, 0.75], ["room_type"], ["q1", "median", "q3"]).drop("n")
    return round_doubles(dens.join(qs, "room_type"))


@query("peak_bin", "D13", oracle=(W.replace("WITH ", f"WITH tb(ord, label, lo, hi) AS ({values_sql(TENURE_BINS)}), "
                                            f"ab(ord, label, lo, hi) AS ({values_sql(AMENITY_BINS)}), ", 1) + f"""
, t AS (SELECT {case_sql_right_closed('v', TENURE_BINS)} AS ord, log_price FROM
        (SELECT {TENURE_SQL} AS v, log_price FROM lc WHERE host_since IS NOT NULL) x WHERE v BETWEEN 0 AND 20),
  tm AS (SELECT t.ord, tb.label, avg(log_price) AS m FROM t JOIN tb ON tb.ord = t.ord GROUP BY t.ord, tb.label),
  a AS (SELECT {case_sql_right_closed('v', AMENITY_BINS)} AS ord, log_price FROM
        (SELECT {AMENITY_SQL} AS v, log_price FROM lc WHERE amenities IS NOT NULL) x WHERE v > 0),
  am AS (SELECT a.ord, ab.label, avg(log_price) AS m FROM a JOIN ab ON ab.ord = a.ord GROUP BY a.ord, ab.label)
SELECT 'host_tenure' AS series, (SELECT label FROM tm ORDER BY m DESC, ord LIMIT 1) AS label,
       round((SELECT max(m) FROM tm), 6) AS mean_target
UNION ALL
SELECT 'amenity' AS series, (SELECT label FROM am ORDER BY m DESC, ord LIMIT 1) AS label,
       round((SELECT max(m) FROM am), 6) AS mean_target""").replace("\n, t AS", ", t AS", 1))
def q_peak(spark, sf):
    lc = listings_clean(spark, sf)
    t = lc.where(F.col("host_since").isNotNull()).withColumn("t", tenure_years()).where(F.col("t").between(0, 20))
    a = lc.where(F.col("amenities").isNotNull()).withColumn("a", list_size("amenities")).where(F.col("a") > 0)
    pt = S.peak(B.binned_mean(t, "t", TENURE_BINS, "log_price"), "label", "mean_target", "ord")
    pa = S.peak(B.binned_mean(a, "a", AMENITY_BINS, "log_price"), "label", "mean_target", "ord")
    out = pt.select(F.lit("host_tenure").alias("series"), "*").unionByName(
        pa.select(F.lit("amenity").alias("series"), "*"))
    return round_doubles(out)


@query("mode_bucket", "D16", oracle=(_P8.replace("WITH ", "WITH ") + ", " + W[len("WITH "):] + f"""
, b AS (SELECT {case_sql_right_closed('price', PRICE_BINS_8)} AS ord FROM (SELECT {PRICE_SQL} AS price FROM lc) t),
  c AS (SELECT ord, count(*) AS n FROM b WHERE ord IS NOT NULL GROUP BY ord)
SELECT c.ord, bins8.label, c.n FROM c JOIN bins8 ON bins8.ord = c.ord ORDER BY c.n DESC, c.ord LIMIT 1""").replace("\n, b AS", ", b AS", 1))
def q_mode_bucket(spark, sf):
    lc = listings_clean(spark, sf)
    counts = (lc.select(right_closed_bin(adaptive_price(lc), PRICE_BINS_8).alias("ord"))
              .groupBy("ord").agg(F.count(F.lit(1)).alias("n")).where(F.col("ord").isNotNull()))
    best = S.mode_by_ordinal(counts)
    labels = bin_table(spark, PRICE_BINS_8).select("ord", "label")
    return best.join(counts, "ord").join(F.broadcast(labels), "ord").select("ord", "label", "n")


_TREND_X = ["accommodates", "bedrooms", "review_scores_rating"]


@query("linear_trend", "D17", oracle=W + f"""
, s AS (SELECT * FROM lc ORDER BY {SAMPLE_ORDER_SQL} LIMIT 3000)
""".replace("\n, s AS", ", s AS", 1) + "\nUNION ALL\n".join(
    f"SELECT '{x}' AS feature, round(regr_slope(log_price, coalesce({x}, 0)), 6) AS slope, "
    f"round(regr_intercept(log_price, coalesce({x}, 0)), 6) AS intercept FROM s" for x in _TREND_X))
def q_linear_trend(spark, sf):
    s = cut_lineage(sample_exact(listings_clean(spark, sf).select("listing_id", "log_price", *_TREND_X), "listing_id", 3000, 42))
    out = None
    for x in _TREND_X:
        t = S.linear_trend(s, x, "log_price").select(F.lit(x).alias("feature"), "*")
        out = t if out is None else out.unionByName(t)
    return round_doubles(out)


@query("availability_profile", "D18", oracle=W + """SELECT count(availability_365) AS n,
  round(avg(availability_365), 6) AS mean_availability FROM lc""")
def q_availability(spark, sf):
    lc = listings_clean(spark, sf)
    return round_doubles(lc.agg(F.count("availability_365").alias("n"),
                                F.avg("availability_365").alias("mean_availability")))


# ---------------------------------------------------------------- 2E sampling
@query("sample_exact", "E1", oracle=W + f"""SELECT listing_id, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, round(log_price, 6) AS log_price FROM lc
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY {SAMPLE_ORDER_SQL} LIMIT 8000""")
def q_sample(spark, sf):
    lc = listings_clean(spark, sf).select("listing_id", "latitude", "longitude", "log_price").dropna()
    return round_doubles(sample_exact(lc, "listing_id", 8000, 42))


@query("geo_color_range", "E6", oracle=W + f"""
, s AS (SELECT listing_id, latitude, longitude, log_price FROM lc
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY {SAMPLE_ORDER_SQL} LIMIT 8000),
  b AS (SELECT quantile_cont(log_price, 0.05) AS lo, quantile_cont(log_price, 0.95) AS hi FROM s)
SELECT listing_id, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude,
  round(log_price, 6) AS log_price, round(least(greatest(log_price, lo), hi), 6) AS color FROM s, b""".replace("\n, s AS", ", s AS", 1))
def q_geo_color(spark, sf):
    lc = listings_clean(spark, sf).select("listing_id", "latitude", "longitude", "log_price").dropna()
    s = cut_lineage(sample_exact(lc, "listing_id", 8000, 42))
    band = exact_quantiles(s, "log_price", [0.05, 0.95], names=["lo", "hi"]).select(
        F.struct("lo", "hi")).scalar()
    out = s.select("listing_id", "longitude", "latitude", "log_price",
                   F.least(F.greatest("log_price", band["lo"]), band["hi"]).alias("color"))
    return round_doubles(out)


# ---------------------------------------------------------------- 2F joins / windows
@query("stat_broadcast", "F3", oracle=W + """
, cm AS (SELECT city, avg(log_price) AS m FROM lc GROUP BY city)
SELECT lc.listing_id, lc.city, round(lc.log_price - cm.m, 6) AS dev_city,
  lc.log_price > (SELECT avg(log_price) FROM lc) AS above_global FROM lc JOIN cm ON cm.city = lc.city""".replace("\n, cm AS", ", cm AS", 1))
def q_stat_broadcast(spark, sf):
    lc = listings_clean(spark, sf)
    cm = lc.groupBy("city").agg(F.avg("log_price").alias("_m"))
    g = lc.select(F.avg("log_price")).scalar()
    out = attach(lc, cm, ["city"]).select("listing_id", "city", (F.col("log_price") - F.col("_m")).alias("dev_city"),
                                     (F.col("log_price") > g).alias("above_global"))
    return round_doubles(out)


@query("minmax_scale_feature", "F8", oracle=W + f"""
, l AS ({_long_sql(NUMERICAL_FEATURES, ids="listing_id, ")}),
  m AS (SELECT feature, min(value) AS mn, max(value) AS mx FROM l GROUP BY feature)
SELECT l.listing_id, l.feature, round(l.value, 6) AS value,
  round((l.value - m.mn) / (m.mx - m.mn + 1e-9), 6) AS scaled FROM l JOIN m ON m.feature = l.feature""".replace("\n, l AS", ", l AS", 1))
def q_minmax(spark, sf):
    lc = listings_clean(spark, sf)
    lng = S.to_long(lc, ["listing_id"], NUMERICAL_FEATURES)
    from tabprism.operators.ranking import minmax_scale
    return round_doubles(minmax_scale(lng, "feature", "value"))
