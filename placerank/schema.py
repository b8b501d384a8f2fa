"""Canonical table schemas and column checks.

``posts``         one short text about an item (a place, a product) inside a group.
``listings_raw``  an offer catalogue as delivered: every attribute a dirty string.
``listings``      the same catalogue after ``clean_listings``: typed and validated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

POSTS = T.StructType(
    [
        T.StructField("post_id", T.LongType(), True),
        T.StructField("item", T.StringType(), True),
        T.StructField("grp", T.StringType(), True),
        T.StructField("period", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

LISTINGS_RAW = T.StructType(
    [
        T.StructField("listing_id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("room_type", T.StringType(), True),
        T.StructField("guests_raw", T.StringType(), True),
        T.StructField("stars_raw", T.StringType(), True),
    ]
)

LISTINGS = T.StructType(
    [
        T.StructField("listing_id", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("room_type", T.StringType(), True),
        T.StructField("guests", T.IntegerType(), True),
        T.StructField("stars", T.FloatType(), True),
    ]
)


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail fast, at plan-building time, when an input lacks a column an operator needs."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
