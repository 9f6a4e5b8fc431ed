"""Feature preparation queries (2H) and the prepared-data helpers used by models."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.functions.scalar import CATEGORICAL_FEATURES, NUMERICAL_FEATURES, round_doubles
from tabprism.operators import features as FE
from tabprism.operators.attach import attach
from tabprism.operators.sampling import remove_outliers, split3
from tabprism.plans.registry import query
from tabprism.sources.listings import listings_clean, listings_learnable, oracle_with

NUM, CAT = NUMERICAL_FEATURES, CATEGORICAL_FEATURES

# Oracle: z-filtered cleaned listings with the hash split (train/val/test).
_SPLIT_CTE = """
, zf AS (SELECT * FROM lc WHERE abs((log_price - (SELECT avg(log_price) FROM lc))
                                   / (SELECT stddev_pop(log_price) FROM lc)) < 3.5),
  sp AS (SELECT *, CASE WHEN b < 6 THEN 'train' WHEN b < 8 THEN 'val' ELSE 'test' END AS split
         FROM (SELECT *, (('0x' || substr(md5(CAST(listing_id AS VARCHAR) || '|42'), 1, 8))::BIGINT) % 10 AS b
               FROM zf) x),
  tr AS (SELECT * FROM sp WHERE split = 'train')
"""
WS = oracle_with() + _SPLIT_CTE


def split_frame(spark: SparkSession, sf: str, learnable: bool = False) -> DataFrame:
    """Cleaned (or learnable) listings, z-filtered on log price, with the H1 split."""
    base = listings_learnable(spark, sf) if learnable else listings_clean(spark, sf)
    return split3(remove_outliers(base, "log_price", 3.5), "listing_id", 42)


@query("split_60_20_20", "H1", oracle=WS + "SELECT listing_id, split FROM sp")
def q_split(spark, sf):
    return split_frame(spark, sf).select("listing_id", "split")


def _strat_sql() -> str:
    from tabprism.plans.text_plans import WN
    return WN + """
, bn AS (SELECT listing_id, label FROM lab WHERE label IN ('Positive', 'Negative')),
  rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(listing_id AS VARCHAR) || '|42') || '|'
                   || CAST(listing_id AS VARCHAR)) - 1 AS r, count(*) OVER (PARTITION BY label) AS nl FROM bn)
SELECT listing_id, label, CASE WHEN r < ceil(0.2 * nl) THEN 'test' ELSE 'train' END AS split FROM rk"""


@query("split_stratified", "H2", oracle=_strat_sql())
def q_split_stratified(spark, sf):
    from tabprism.plans.text_plans import binary_split
    return binary_split(spark, sf).select("listing_id", "label", "split")


def _median_cte():
    return ", md AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUM) + " FROM tr)\n"


@query("impute_median", "H3", oracle=WS + _median_cte() + "SELECT listing_id, split, " + ", ".join(
    f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in NUM) + " FROM sp, md")
def q_impute_median(spark, sf):
    sp = split_frame(spark, sf)
    med = FE.fit_medians(sp.where(F.col("split") == "train"), NUM)
    m = med.groupBy().pivot("feature", NUM).agg(F.first("median"))  # one row, 8 columns
    mm = m.select(F.struct(*NUM).alias("m")).select("m").scalar()
    return round_doubles(sp.select("listing_id", "split", *[F.coalesce(F.col(c), mm[c]).alias(c) for c in NUM]))


_SCALE_SQL = WS + _median_cte() + ", im AS (SELECT listing_id, split, " + ", ".join(
    f"coalesce({c}, m_{c}) AS {c}" for c in NUM) + " FROM sp, md),\n  sc AS (SELECT " + ", ".join(
    f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS sd_{c}" for c in NUM) + \
    " FROM im WHERE split = 'train')\nSELECT listing_id, split, " + ", ".join(
    f"round(({c} - mu_{c}) / sd_{c}, 6) AS {c}" for c in NUM) + " FROM im, sc"


@query("standard_scale", "H4", oracle=_SCALE_SQL)
def q_standard_scale(spark, sf):
    sp = split_frame(spark, sf)
    train = sp.where(F.col("split") == "train")
    med = {r["feature"]: r["median"] for r in FE.fit_medians(train, NUM).collect()}  # 8 values
    st = {r["feature"]: (r["mean"], r["std"]) for r in FE.fit_scaling(train, NUM, med).collect()}
    cols = [((FE.impute_expr(c, med[c]) - st[c][0]) / st[c][1]).alias(c) for c in NUM]
    return round_doubles(sp.select("listing_id", "split", *cols))


def _mode_cte():
    parts = []
    for c in CAT:
        parts.append(f"(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mo_{c}")
    return ", mo AS (SELECT " + ", ".join(parts) + ")\n"


@query("impute_mode", "H5", oracle=WS + _mode_cte() + "SELECT listing_id, split, " + ", ".join(
    f"coalesce({c}, mo_{c}) AS {c}" for c in CAT) + " FROM sp, mo")
def q_impute_mode(spark, sf):
    sp = split_frame(spark, sf)
    modes = FE.fit_modes(sp.where(F.col("split") == "train"), CAT)
    mv = modes.groupBy().pivot("feature", CAT).agg(F.first("mode")).select(F.struct(*CAT)).scalar()
    return sp.select("listing_id", "split", *[F.coalesce(F.col(c), mv[c]).alias(c) for c in CAT])


_ONEHOT_SQL = WS + _mode_cte() + ", im AS (SELECT listing_id, split, " + ", ".join(
    f"coalesce({c}, mo_{c}) AS {c}" for c in CAT) + " FROM sp, mo),\n  lg AS (" + "\nUNION ALL\n".join(
    f"SELECT listing_id, split, '{c}' AS feature, {c} AS category FROM im" for c in CAT) + """),
  cats AS (SELECT DISTINCT feature, category FROM lg WHERE split = 'train')
SELECT lg.listing_id, lg.feature || '_' || lg.category AS feature_name
FROM lg JOIN cats ON cats.feature = lg.feature AND cats.category = lg.category"""


@query("one_hot", "H6", oracle=_ONEHOT_SQL)
def q_one_hot(spark, sf):
    sp = split_frame(spark, sf)
    train = sp.where(F.col("split") == "train")
    modes = FE.fit_modes(train, CAT)
    mv = modes.groupBy().pivot("feature", CAT).agg(F.first("mode")).select(F.struct(*CAT)).scalar()
    imputed = sp.select("listing_id", "split", *[F.coalesce(F.col(c), mv[c]).alias(c) for c in CAT])
    lng = imputed.unpivot(["listing_id", "split"], CAT, "feature", "category")
    cats = lng.where(F.col("split") == "train").select("feature", "category").distinct()
    # categories seen in train; an unseen category has no slot (all-zero block)
    hot = attach(lng, cats, ["feature", "category"])
    return hot.select("listing_id", F.concat_ws("_", "feature", "category").alias("feature_name"))


def prepared(spark: SparkSession, sf: str, learnable: bool = True, sp: DataFrame | None = None):
    """(prepared frame with features/label/split, fitted preprocessor); ``sp``: the split frame, if
    it is there already. The fit reads it some eight times, each time with its joins if they are not cut."""
    sp = split_frame(spark, sf, learnable=learnable) if sp is None else sp
    pre = FE.fit_preprocessor(sp.where(F.col("split") == "train"), NUM, CAT)
    label = "y" if learnable else "log_price"
    out = pre.transform(sp).select("listing_id", "split", "features", F.col(label).alias("label"), *NUM, *CAT)
    return out, pre


# The vector in long form: one row per numeric slot and per one-hot slot that is set.
_VECTOR_SQL = (_SCALE_SQL.replace("\nSELECT listing_id, split, ", ",\n  zz AS (SELECT listing_id, ", 1) + ")" +
               _mode_cte() + """, ic AS (SELECT listing_id, split, """ + ", ".join(f"coalesce({c}, mo_{c}) AS {c}" for c in CAT) + """ FROM sp, mo),
  lg AS (""" + "\nUNION ALL\n".join(f"SELECT listing_id, split, {i} AS fi, '{c}' AS feature, {c} AS category FROM ic" for i, c in enumerate(CAT)) + """),
  cats AS (SELECT fi, feature, category, CAST(row_number() OVER (ORDER BY fi, category) - 1 AS INTEGER) AS pos
           FROM (SELECT DISTINCT fi, feature, category FROM lg WHERE split = 'train') q)
""" + "\nUNION ALL\n".join(f"SELECT listing_id, {i} AS slot, '{c}' AS feature, {c} AS value FROM zz" for i, c in enumerate(NUM)) + f"""
UNION ALL SELECT lg.listing_id, {len(NUM)} + cats.pos, lg.feature || '_' || lg.category, 1.0
FROM lg JOIN cats ON cats.feature = lg.feature AND cats.category = lg.category""")


@query("feature_vector", "H7", oracle=_VECTOR_SQL)
def q_feature_vector(spark, sf):
    """The assembled vector of each row in long form, with each slot's feature name."""
    out, pre = prepared(spark, sf, learnable=False)
    names = pre.feature_names()  # bounded by the feature catalog and its categories
    long = out.select("listing_id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    table = spark.createDataFrame(list(enumerate(names)), "slot int, feature string")
    long = attach(long, table, ["slot"])
    return round_doubles(long.where((F.col("slot") < len(NUM)) | (F.col("value") != 0)).select("listing_id", "slot", "feature", "value"))


@query("feature_names", "H8", oracle=WS + _mode_cte() + ", im AS (SELECT split, " + ", ".join(
    f"coalesce({c}, mo_{c}) AS {c}" for c in CAT) + " FROM sp, mo),\n  cats AS (" + "\nUNION ALL\n".join(
    f"SELECT DISTINCT {i} AS fi, '{c}' AS feature, {c} AS category FROM im WHERE split = 'train'"
    for i, c in enumerate(CAT)) + "),\n  nm AS (" + "\nUNION ALL\n".join(
    f"SELECT {i} AS fi, '' AS category, '{c}' AS feature_name" for i, c in enumerate(NUM)) + """
  UNION ALL SELECT 100 + fi, category, feature || '_' || category FROM cats)
SELECT CAST(row_number() OVER (ORDER BY fi, category) - 1 AS INTEGER) AS ord, feature_name AS feature FROM nm""")
def q_feature_names(spark, sf):
    sp = split_frame(spark, sf)
    train = sp.where(F.col("split") == "train")
    modes = FE.fit_modes(train, CAT)
    cats = FE.fit_categories(train, CAT, {r["feature"]: r["mode"] for r in modes.collect()})
    order = {c: i for i, c in enumerate(CAT)}
    fi = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(100 + i))])
    catnames = cats.select(fi[F.col("feature")].alias("fi"), "category",
                           F.concat_ws("_", "feature", "category").alias("feature"))
    nums = spark.createDataFrame([(i, "", c) for i, c in enumerate(NUM)], "fi int, category string, feature string")
    from pyspark.sql import Window
    allf = nums.unionByName(catnames)
    # the window runs over the feature-name list (bounded by the catalog's categories)
    return allf.select((F.row_number().over(Window.orderBy("fi", "category")) - 1).alias("ord"), "feature")
