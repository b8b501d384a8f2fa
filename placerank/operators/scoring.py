"""Popularity scoring: posts per (item, grp), min-max scaled to 0-100 over all pairs,
rounded to 2 decimals, ranked inside each group.

Plan shape: one aggregate per (item, grp) with a partial step; the min/max is a one-row
aggregate of that same grouped table broadcast back (AQE reuses the exchange, so the input
is scanned once). The in-group rank is computed without putting a whole group in one task:
``rank`` = 1 + the number of pairs of the same group with a strictly higher score, and
since the score is rounded to 0.01 on [0, 100] a group has at most 10,001 distinct scores.
The window therefore runs over (grp, score, count) rows, at most 10,001 per group, and the
ranks are joined back on (grp, score); the join side is small, so AQE broadcasts it by its
measured size, and a skewed (grp, score) key is split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import attach_scalars, min_max_scaled
from ..functions.columns import desc_keys
from ..schema import require_columns


def item_counts(posts: DataFrame, keys: tuple[str, ...] = ("item", "grp")) -> DataFrame:
    require_columns(posts, *keys)
    return posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("review_count"))


def scored_counts(counts: DataFrame) -> DataFrame:
    """(keys..., review_count) -> the same with ``popularity_score``. NULL score when all
    counts are equal (max == min)."""
    with_stats = attach_scalars(
        counts, F.min("review_count").alias("_min_n"), F.max("review_count").alias("_max_n")
    )
    score = F.round(min_max_scaled(F.col("review_count"), F.col("_min_n"), F.col("_max_n"), 100.0), 2)
    return with_stats.withColumn("popularity_score", score).drop("_min_n", "_max_n")


def rank_within(df: DataFrame, part: str, score: str, rank_col: str) -> DataFrame:
    """``rank()`` of ``score`` (descending, NULLs last) within ``part``, computed over the
    distinct (part, score) values only. Exact for any score; the window is bounded when
    the score has a bounded number of distinct values (a rounded, bounded score)."""
    per_value = df.groupBy(part, score).agg(F.count(F.lit(1)).alias("_n"))
    w = (
        Window.partitionBy(part)
        .orderBy(F.col(score).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = per_value.select(
        F.col(part).alias("_rp"),
        F.col(score).alias("_rs"),
        (F.lit(1) + F.coalesce(F.sum("_n").over(w), F.lit(0))).cast("int").alias(rank_col),
    )
    cond = df[part].eqNullSafe(ranks["_rp"]) & df[score].eqNullSafe(ranks["_rs"])
    return df.join(ranks, cond, "inner").drop("_rp", "_rs")


def popularity_score(posts: DataFrame) -> DataFrame:
    """(item, grp, review_count, popularity_score, group_rank), best first."""
    return popularity_of_counts(item_counts(posts))


def summed_counts(counts: DataFrame, keys: tuple[str, ...] = ("item", "grp")) -> DataFrame:
    """One count per key from rows of ``item_counts`` that were taken part by part (a day's posts
    each) and stored. Over a table bucketed on the keys the sum needs no exchange."""
    require_columns(counts, *keys, "review_count")
    return counts.groupBy(*keys).agg(F.sum("review_count").alias("review_count"))


def popularity_of_counts(counts: DataFrame) -> DataFrame:
    """``popularity_score`` of counted pairs (item, grp, review_count), one row a pair."""
    scored = scored_counts(counts)
    ranked = rank_within(scored, "grp", "popularity_score", "group_rank")
    return ranked.select(
        "item", "grp", "review_count", "popularity_score", "group_rank"
    ).orderBy(*desc_keys("popularity_score", "item", "grp"))


def top_popular(popularity: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` rows of a popularity table in its total order."""
    return popularity.orderBy(*desc_keys("popularity_score", "item", "grp")).limit(n)


def browse_popular(popularity: DataFrame, grp: str | None = None, min_score: float = 10.0,
                   n: int = 10) -> DataFrame:
    """Popularity browsing without keywords: optional group filter (``None`` = all groups),
    ``popularity_score >= min_score``, best ``n``."""
    out = popularity
    if grp is not None:
        out = out.where(F.col("grp") == F.lit(grp))
    out = out.where(F.col("popularity_score") >= F.lit(float(min_score)))
    return out.orderBy(*desc_keys("popularity_score", "item", "grp")).limit(n)


def avg_popularity_by_group(popularity: DataFrame) -> DataFrame:
    """Mean popularity per group (rounded to 4 decimals), highest first:
    (grp, avg_popularity). As in pandas' ``groupby``, a NULL group is left out."""
    out = popularity.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.round(F.avg("popularity_score"), 4).alias("avg_popularity"))
    return out.orderBy(*desc_keys("avg_popularity", "grp"))
