"""Row-level column functions (section B). All are built-in expressions, so they
compile into the surrounding whole-stage codegen span and push nothing to Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference's time anchor and feature catalog.
TENURE_AS_OF = "2024-01-01"
NUMERICAL_FEATURES = ["accommodates", "bathrooms", "bedrooms", "beds",
                      "number_of_reviews", "review_scores_rating", "latitude", "longitude"]
CATEGORICAL_FEATURES = ["neighbourhood", "room_type", "property_type", "city", "bed_type",
                        "cancellation_policy", "instant_bookable", "host_identity_verified",
                        "host_has_profile_pic"]
TARGET = "log_price"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_from_log(c="log_price") -> Column:
    """B1."""
    return F.exp(col_(c))


def log1p_(c) -> Column:
    """B2."""
    return F.log1p(col_(c))


def global_max(df: DataFrame, c: str) -> Column:
    """A one-value scalar subquery: Spark runs it once and inlines the literal,
    so no join (and no cross join) is planned against the big side."""
    return df.select(F.max(c)).scalar()


def adaptive_price(df: DataFrame, target: str = "log_price", limit: float = 20.0) -> Column:
    """exp(target) only if the global max of the target is below ``limit``."""
    return F.when(global_max(df, target) < F.lit(limit), F.exp(F.col(target))).otherwise(F.col(target))


def parse_percent(c, strict: bool = False) -> Column:
    """A3: strip ``%`` and cast; junk -> NULL (``try_cast`` is ANSI-safe), or an error if ``strict``."""
    bare = F.regexp_replace(col_(c), "%", "")
    value = bare.try_cast(T.DoubleType())
    if not strict:
        return value
    return F.when(bare.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit("no percentage: "), col_(c))).cast("double")).otherwise(value)


def tenure_years(c="host_since", as_of: str = TENURE_AS_OF) -> Column:
    """Whole days from the date to ``as_of`` divided by 365; unparsable -> NULL."""
    d = F.to_date(F.try_to_timestamp(col_(c)))
    return F.datediff(F.to_date(F.lit(as_of)), d) / F.lit(365.0)


def list_size(c, sep: str = ",") -> Column:
    """Number of ``sep``-separated parts (empty string counts as one)."""
    return F.size(F.split(col_(c), sep))


def normalise_text(c) -> Column:
    """Lower-case and strip surrounding whitespace (Python ``strip`` semantics)."""
    return F.regexp_replace(F.lower(col_(c)), r"(?U)^\s+|\s+$", "")


def fill_zero(c) -> Column:
    """B9."""
    return F.coalesce(col_(c), F.lit(0))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (engine-independent output for hashing)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def feature_lists(df: DataFrame) -> tuple[list[str], list[str]]:
    """A4: the catalog features present in ``df`` (numeric, categorical)."""
    have = set(df.columns)
    return ([c for c in NUMERICAL_FEATURES if c in have],
            [c for c in CATEGORICAL_FEATURES if c in have])


def select_features(df: DataFrame, key: str = "listing_id", target: str = TARGET) -> DataFrame:
    num, cat = feature_lists(df)
    keep = [c for c in [key] if c in df.columns] + num + cat + [c for c in [target] if c in df.columns]
    return df.select(*keep)
