"""Counting operators over ``posts``.

Every count is a hash aggregate with a partial (map-side) step, so a hot key is reduced
inside each input task before the shuffle and a key holding a third of the rows costs one
partial row per task. Top-k uses ``orderBy(...).limit(n)``, which Catalyst plans as
TakeOrderedAndProject (a per-partition heap, then a merge of at most n rows per task).
Every order is total: ties are broken on the key columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attach_stats, count_distinct_values
from ..functions.columns import desc_keys
from ..schema import require_columns


def top_items(posts: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` items with the most posts: (item, review_count)."""
    require_columns(posts, "item")
    counts = posts.groupBy("item").agg(F.count(F.lit(1)).alias("review_count"))
    return counts.orderBy(*desc_keys("review_count", "item")).limit(n)


def group_counts(posts: DataFrame) -> DataFrame:
    """Posts per group, most first: (grp, review_count)."""
    require_columns(posts, "grp")
    counts = posts.groupBy("grp").agg(F.count(F.lit(1)).alias("review_count"))
    return counts.orderBy(*desc_keys("review_count", "grp"))


def group_shares(posts: DataFrame) -> DataFrame:
    """Posts per group and their share of all posts in percent: (grp, review_count,
    share_pct). The total is a one-row aggregate of the grouped table broadcast back, not
    a window over the whole table (which would put every group in one task)."""
    require_columns(posts, "grp")
    counts = posts.groupBy("grp").agg(F.count(F.lit(1)).alias("review_count"))
    shares = attach_stats(counts, counts, F.sum("review_count").alias("_total")).select(
        "grp",
        "review_count",
        (F.col("review_count").cast("double") * F.lit(100.0) / F.col("_total").cast("double"))
        .alias("share_pct"),
    )
    return shares.orderBy(*desc_keys("review_count", "grp"))


def period_trend(posts: DataFrame) -> DataFrame:
    """Posts per period label, ordered by the label as text (so "10 months ago" sorts
    before "2 months ago", as in the reference): (period, review_count)."""
    require_columns(posts, "period")
    counts = posts.groupBy("period").agg(F.count(F.lit(1)).alias("review_count"))
    return counts.orderBy(F.col("period").asc_nulls_first())


def distinct_items_per_group(posts: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """Number of different items per group (NULL items not counted): (grp, unique_items).
    Catalyst plans the single distinct count as a dedup aggregate on (grp, item) followed
    by a count per grp; both have partial steps, so a hot pair or group is reduced before
    each shuffle. ``approx_rsd`` uses a HyperLogLog++ sketch per group instead."""
    require_columns(posts, "grp", "item")
    counts = posts.groupBy("grp").agg(count_distinct_values("item", approx_rsd).alias("unique_items"))
    return counts.orderBy(*desc_keys("unique_items", "grp"))


def value_options(df: DataFrame, column: str, sentinel: str, alias: str | None = None) -> DataFrame:
    """Sorted distinct values of ``column`` with ``sentinel`` first: a one-column option
    list ordered by an ordinal, not by driver-side list building."""
    require_columns(df, column)
    name = alias or column
    values = df.select(F.col(column).alias(name)).distinct().withColumn("_first", F.lit(1))
    head = df.sparkSession.range(1).select(F.lit(sentinel).alias(name), F.lit(0).alias("_first"))
    return (
        head.unionByName(values)
        .orderBy(F.col("_first"), F.col(name).asc_nulls_first())
        .select(name)
    )


# Fixed value: the option that stands for "no group filter" in the reference's UI.
ALL_GROUPS = "All Districts"


def group_options(posts: DataFrame, sentinel: str = ALL_GROUPS) -> DataFrame:
    """Sorted distinct groups with the "all groups" sentinel first: (grp)."""
    return value_options(posts, "grp", sentinel)
