"""Schemas of the inputs, the two stores and the result."""

from pyspark.sql import types as T

# Raw purchases: one row per purchase line, date as a 'yyyyMMdd' string.
RAW_PURCHASES = T.StructType(
    [
        T.StructField("hhkey", T.LongType()),
        T.StructField("occaskey", T.LongType()),
        T.StructField("recid", T.LongType()),
        T.StructField("brand", T.StringType()),
        T.StructField("datep", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("brandfactor", T.DoubleType()),
        T.StructField("rwkorr", T.DoubleType()),
        T.StructField("rwstd", T.DoubleType()),
        T.StructField("fullmasW", T.DoubleType()),
        T.StructField("continuo", T.DoubleType()),
    ]
)

HOUSEHOLDS = T.StructType(
    [
        T.StructField("hhkey", T.LongType()),
        T.StructField("continuo", T.DoubleType()),
    ]
)

# Brand map: both columns NOT NULL; `brand` is not declared unique.
BRAND_MAP = T.StructType(
    [
        T.StructField("brand", T.StringType(), nullable=False),
        T.StructField("aggregation", T.StringType(), nullable=False),
    ]
)

# Pre-weighted store (one row per purchase, household weight applied at load).
WEIGHTED_PURCHASES = T.StructType(
    [
        T.StructField("hhkey", T.LongType()),
        T.StructField("brand", T.StringType()),
        T.StructField("datep", T.DateType()),
        T.StructField("spent_cs", T.DoubleType()),
        T.StructField("spent_fs", T.DoubleType()),
    ]
)

GAIN_LOSS = T.StructType(
    [
        T.StructField("B1", T.StringType()),
        T.StructField("B2", T.StringType()),
        T.StructField("total_gains_b1_to_b2", T.DoubleType()),
        T.StructField("total_losses_b1_to_b2", T.DoubleType()),
    ]
)

MEASURES = ("value", "brandfactor", "rwkorr", "rwstd", "fullmasW")
