"""Read the raw purchase and household tables with explicit schemas.

All purchase columns are offered, since a store keeps them all; a columnar
source reads only those that a query uses, and a column it lacks is NULL. Other formats get the schema applied at read time (no
inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import HOUSEHOLDS, RAW_PURCHASES

_FORMATS = ("parquet", "orc", "csv", "json")


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, **options) -> DataFrame:
    if fmt not in _FORMATS:
        raise ValueError(f"format must be one of {_FORMATS}")
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
    if fmt in ("csv", "json"):
        return reader.schema(schema).load(path)
    # self-describing formats: read the file schema, then select and cast
    df = reader.load(path)
    there = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_purchases(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Raw purchases: ``hhkey, occaskey, recid, brand, datep ('yyyyMMdd'), value, brandfactor, rwkorr, rwstd, fullmasW, continuo``."""
    return _read(spark, path, RAW_PURCHASES, fmt, **options)


def read_households(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Household weights: ``hhkey, continuo`` (other columns are not read)."""
    return _read(spark, path, HOUSEHOLDS, fmt, **options)
