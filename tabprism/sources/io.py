"""A1: read a listings table from CSV (or parquet) into the Spark types of SURVEY 1.

CSV is read with a header and either an explicit schema (recommended: no inference
pass over the data) or ``inferSchema``. Quoted multi-line fields and doubled-quote
escapes are supported (free-text descriptions contain both). NaN is turned into NULL
at the scan, because Spark aggregates skip NULL but not NaN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprism.functions.scalar import CATEGORICAL_FEATURES, NUMERICAL_FEATURES

# The column types of the listings table.
LISTINGS_SCHEMA = T.StructType(
    [T.StructField("listing_id", T.LongType()), T.StructField("log_price", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERICAL_FEATURES]
    + [T.StructField(c, T.StringType()) for c in CATEGORICAL_FEATURES]
    + [T.StructField("host_since", T.StringType()), T.StructField("host_response_rate", T.StringType()),
       T.StructField("amenities", T.StringType()), T.StructField("availability_365", T.IntegerType()),
       T.StructField("description", T.StringType()), T.StructField("name", T.StringType())])


def nan_to_null(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_listings(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = LISTINGS_SCHEMA,
                  multi_line: bool = True, corrupt_column: str | None = None) -> DataFrame:
    """Read listings; ``schema=None`` infers types (an extra pass over the CSV).

    ``multi_line=False`` lets Spark split files (for data without line ends in fields;
    with it each file is one task). Rows that do not parse raise an error, unless
    ``corrupt_column`` names a column to keep them in.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        reader = (spark.read.option("header", True).option("multiLine", multi_line)
                  .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE" if corrupt_column else "FAILFAST"))
        if corrupt_column:
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
            if schema is not None and corrupt_column not in schema.fieldNames():
                schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
    else:
        raise ValueError(f"unsupported format {fmt}")
    return nan_to_null(df)


def write_listings_csv(df: DataFrame, path: str) -> None:
    """Write listings as CSV with a header (quoted multi-line text survives a round trip)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
