"""Attach one-row statistics to every row without a driver round trip.

A global aggregate (no grouping keys) always yields exactly one row, even over an empty
input, so a cross join with it never drops rows and is size-bounded by construction: the
broadcast side is one row. Catalyst plans it as a BroadcastNestedLoopJoin against a single
row, and when the statistics aggregate over the same grouped table as the rows they are
attached to, AQE reuses that exchange instead of scanning the input twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_scalars(df: DataFrame, *aggs: Column) -> DataFrame:
    """``df`` with the columns of ``df.agg(*aggs)`` appended to every row."""
    return attach_stats(df, df, *aggs)


def attach_stats(df: DataFrame, source: DataFrame, *aggs: Column) -> DataFrame:
    """``df`` with the columns of ``source.agg(*aggs)``, one row by construction, appended to
    every row."""
    return df.crossJoin(F.broadcast(source.agg(*aggs)))


def min_max_scaled(value: Column, lo: Column, hi: Column, scale: float = 1.0) -> Column:
    """``(value - lo) / (hi - lo) * scale``; NULL when ``hi == lo`` (``try_divide``), which
    is what non-ANSI Spark returned for x/0 and keeps ANSI mode from raising."""
    num = value.cast("double") - lo.cast("double")
    den = hi.cast("double") - lo.cast("double")
    scaled = F.try_divide(num, den)
    return scaled * F.lit(float(scale)) if scale != 1.0 else scaled
