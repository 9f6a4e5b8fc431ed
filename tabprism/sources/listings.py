"""The portable ``listings`` view over the driver's tables, and its cleaned forms.

One list of ``(alias, expression)`` pairs drives both engines: Spark evaluates the
expressions with ``selectExpr`` over DataFrame joins, and the DuckDB oracle gets the
same text as a ``WITH listings AS (...)`` CTE. The expressions plant nulls, zeros,
bad dates and unseen keys by modulus because the driver's tables hold no nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.sources.tables import read_table

# The listings view definition shared with the test fixtures.
LISTING_COLUMNS: list[tuple[str, str]] = [
    ("listing_id", "o.o_orderkey"),
    ("log_price", "CASE WHEN o.o_orderkey % 211 = 0 THEN NULL "
                  "WHEN o.o_orderkey % 223 = 0 THEN CAST(0 AS DOUBLE) "
                  "ELSE ln(o.o_totalprice / 400) END"),
    ("accommodates", "CAST(1 + o.o_orderkey % 16 AS DOUBLE)"),
    ("bathrooms", "CASE WHEN o.o_orderkey % 97 = 0 THEN NULL "
                  "ELSE CAST(o.o_orderkey % 7 AS DOUBLE) / 2 END"),
    ("bedrooms", "CASE WHEN o.o_orderkey % 89 = 0 THEN NULL "
                 "ELSE CAST(o.o_custkey % 6 AS DOUBLE) END"),
    ("beds", "CASE WHEN o.o_orderkey % 83 = 0 THEN NULL "
             "ELSE CAST(1 + o.o_orderkey % 9 AS DOUBLE) END"),
    ("number_of_reviews", "CAST(o.o_custkey % 300 AS DOUBLE)"),
    ("review_scores_rating", "CASE WHEN o.o_orderkey % 5 = 0 THEN NULL "
                             "ELSE CAST(60 + o.o_custkey % 41 AS DOUBLE) END"),
    ("latitude", "30 + CAST(c.c_nationkey AS DOUBLE) + CAST(o.o_orderkey % 1000 AS DOUBLE) / 1000"),
    ("longitude", "-120 + 2 * CAST(c.c_nationkey AS DOUBLE) + CAST(o.o_custkey % 1000 AS DOUBLE) / 1000"),
    ("neighbourhood", "CASE WHEN o.o_orderkey % 11 = 0 THEN NULL "
                      "ELSE concat(n.n_name, '/', c.c_mktsegment) END"),
    ("room_type", "o.o_orderstatus"),
    ("property_type", "c.c_mktsegment"),
    ("city", "n.n_name"),
    ("bed_type", "CASE WHEN o.o_orderkey % 3 = 0 THEN 'Futon' ELSE 'Real Bed' END"),
    ("cancellation_policy", "o.o_orderpriority"),
    ("instant_bookable", "CASE WHEN o.o_custkey % 2 = 0 THEN 't' ELSE 'f' END"),
    ("host_identity_verified", "CASE WHEN o.o_orderkey % 13 = 0 THEN NULL "
                               "WHEN o.o_custkey % 3 = 0 THEN 'f' ELSE 't' END"),
    ("host_has_profile_pic", "CASE WHEN o.o_custkey % 50 = 0 THEN 'f' ELSE 't' END"),
    ("host_since", "CASE WHEN o.o_orderkey % 101 = 0 THEN 'bad-date' "
                   "WHEN o.o_orderkey % 103 = 0 THEN NULL "
                   "ELSE CAST(DATE '2003-06-01' + CAST(o.o_orderkey * 37 % 7600 AS INT) AS STRING) END"),
    ("host_response_rate", "CASE WHEN o.o_orderkey % 6 = 0 THEN NULL "
                           "ELSE concat(CAST(o.o_custkey % 101 AS STRING), '%') END"),
    ("amenities", "concat(repeat('Wifi,', CAST(o.o_orderkey % 60 AS INT)), 'TV')"),
    ("availability_365", "CAST(o.o_custkey % 366 AS INT)"),
    ("description", "d.text"),
    ("name", "p.p_name"),
]

LISTINGS_FROM = ("FROM orders o "
                 "JOIN customer c ON c.c_custkey = o.o_custkey "
                 "JOIN nation n ON n.n_nationkey = c.c_nationkey "
                 "LEFT JOIN documents d ON d.doc_id = o.o_orderkey "
                 "LEFT JOIN part p ON p.p_partkey = o.o_orderkey")

# Learnable target for model and explanation operators (fixed values).
LEARNABLE_TARGET = ("0.3 * log_price + 0.06 * accommodates + 0.10 * coalesce(bedrooms, 0) "
                    "+ CASE room_type WHEN 'F' THEN 0.5 WHEN 'O' THEN 0.2 ELSE 0 END")


def listings_sql() -> str:
    cols = ",\n  ".join(f"{expr} AS {alias}" for alias, expr in LISTING_COLUMNS)
    return f"SELECT {cols}\n{LISTINGS_FROM}"


def oracle_with(*extra_ctes: str) -> str:
    """``WITH listings AS (...), lc AS (...), ls AS (...)`` prefix for oracle SQL."""
    ctes = [f"listings AS ({listings_sql()})",
            "lc AS (SELECT * FROM listings WHERE log_price IS NOT NULL AND log_price > 0)",
            f"ls AS (SELECT *, {LEARNABLE_TARGET} AS y FROM lc)"]
    ctes.extend(extra_ctes)
    return "WITH " + ",\n".join(ctes) + "\n"


TEXT_COLUMNS = ("description", "name")


def listings(spark: SparkSession, sf_dir: str, text: bool | tuple[str, ...] = False) -> DataFrame:
    """Build ``listings`` from the driver tables with the DataFrame API.

    Only the columns the view needs are read (parquet column pruning). ``nation`` is
    a fixed 25-row dimension and is broadcast; every other join is left to the
    planner/AQE, which broadcasts at runtime only below its size threshold.
    ``documents`` and ``part`` join on the order key, so one hash partitioning of
    the order side serves both joins. They only feed ``description`` and ``name``,
    so each is joined only when ``text`` names its column (True: both; Spark does not
    drop unused outer joins on its own); columns that are not named are absent.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority").alias("o")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment").alias("c")
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")).alias("n")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text").alias("d")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name").alias("p")
    joined = (o.join(c, F.col("c.c_custkey") == F.col("o.o_custkey"))
              .join(n, F.col("n.n_nationkey") == F.col("c.c_nationkey")))
    wanted = TEXT_COLUMNS if text is True else text or ()
    if "description" in wanted:
        joined = joined.join(d, F.col("d.doc_id") == F.col("o.o_orderkey"), "left")
    if "name" in wanted:
        joined = joined.join(p, F.col("p.p_partkey") == F.col("o.o_orderkey"), "left")
    cols = [(a, e) for a, e in LISTING_COLUMNS if a not in TEXT_COLUMNS or a in wanted]
    return joined.selectExpr(*[f"{expr} AS {alias}" for alias, expr in cols])


def clean_target(df: DataFrame, target: str = "log_price") -> DataFrame:
    """A2: keep rows whose target is present (neither NULL nor NaN) and positive."""
    kept = F.col(target).isNotNull() & (F.col(target) > 0)
    return df.filter(kept & ~F.isnan(target) if dict(df.dtypes)[target] in ("double", "float") else kept)


def listings_clean(spark: SparkSession, sf_dir: str, text: bool | tuple[str, ...] = False) -> DataFrame:
    """``Lc``: the cleaned listings."""
    return clean_target(listings(spark, sf_dir, text))


def listings_learnable(spark: SparkSession, sf_dir: str, text: bool | tuple[str, ...] = False) -> DataFrame:
    """``Ls``: ``Lc`` plus the learnable target ``y``."""
    return listings_clean(spark, sf_dir, text).withColumn("y", F.expr(LEARNABLE_TARGET))
