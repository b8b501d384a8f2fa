"""Keyword ranking: rank (item, grp) pairs by keyword density (80 %) blended with
popularity (20 %), plus the summaries of a ranking a results page shows.

Plan: one pass over the posts computes per-post keyword hits (a literal substring count,
no text concatenation), one aggregate per (item, grp) gives the post count and the summed
hits; min/max count (for popularity) and the maximum kept density come from ONE one-row
aggregate over that grouped table, broadcast back, so AQE reuses the exchange and the text
is scanned once. Popularity comes from the same aggregate (same keys), so no join is
needed; the reference's item-only join is the grouped table joined with itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attach_scalars, clean_keywords, keyword_hits, min_max_scaled
from ..functions.columns import desc_keys
from ..schema import require_columns

# Fixed values of the reference's keyword ranking.
RELEVANCE_WEIGHT = 0.8
POPULARITY_WEIGHT = 0.2
MIN_DENSITY_PER_KEYWORD = 0.05  # density must reach this times the number of keywords
DENSITY_FLOOR = 0.001  # lower bound of the maximum density used for scaling

RANKING_COLUMNS = ["item", "grp", "review_count", "keyword_freq", "relevance_score", "final_score"]

# Display names of result columns, per result kind.
DISPLAY_NAMES = {
    "keyword": {
        "item": "Destination",
        "grp": "District",
        "review_count": "Total Reviews",
        "keyword_freq": "Keyword Mentions",
        "relevance_score": "Relevance Score",
        "final_score": "Final Score",
    },
    "popularity": {
        "item": "Destination",
        "grp": "District",
        "review_count": "Total Reviews",
        "popularity_score": "Popularity Score",
        "group_rank": "District Rank",
    },
}


def _empty_ranking(posts: DataFrame) -> DataFrame:
    """The six ranking columns, no rows (lineage kept; Catalyst folds it to empty)."""
    return posts.where(F.lit(False)).select(
        "item",
        "grp",
        F.lit(0).cast("long").alias("review_count"),
        F.lit(0.0).alias("keyword_freq"),
        F.lit(0.0).alias("relevance_score"),
        F.lit(0.0).alias("final_score"),
    )


def keyword_ranking(posts: DataFrame, keywords: Sequence[str], n: int = 10,
                    grp: str | None = None, group_filter_stage: str = "after",
                    min_final_score: float | None = None,
                    join_keys: Sequence[str] = ("item", "grp"),
                    keyword_match: str = "literal") -> DataFrame:
    """(item, grp, review_count, keyword_freq, relevance_score, final_score), best first.

    * hits of a keyword in a post: non-overlapping literal, case-insensitive occurrences
      (substrings count: "art" in "party"); ``keyword_freq`` sums them over keywords and
      posts; density = keyword_freq / review_count;
    * pairs with density >= 0.05 * number of keywords are kept;
    * relevance = round(density / max(max kept density, 0.001) * 100, 2);
    * final = round(0.8 * relevance + 0.2 * coalesce(popularity, 0), 2), popularity being
      the min-max scaled post count over all pairs;
    * ``grp`` filters to one group, after the top-n (default, as the reference's page does)
      or before it (``group_filter_stage="before"``); ``min_final_score`` drops lower rows.
    * ``join_keys=("item",)`` reproduces the reference's popularity join on the item only
      (an item in several groups then repeats with each group's popularity);
    * ``keyword_match="regex"`` reproduces its keyword-as-pattern counting (removed
      characters / keyword length) instead of literal occurrences.
    Keywords are trimmed and lowercased; no keywords gives an empty result.
    """
    require_columns(posts, "item", "grp", "text")
    kws = clean_keywords(keywords)
    if not kws:
        return _empty_ranking(posts)
    if group_filter_stage not in ("after", "before"):
        raise ValueError("group_filter_stage must be 'after' or 'before'")
    threshold = MIN_DENSITY_PER_KEYWORD * len(kws)

    per_post = posts.select("item", "grp", keyword_hits(F.lower(F.col("text")), kws, keyword_match).alias("_hits"))
    grouped = per_post.groupBy("item", "grp").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.coalesce(F.sum("_hits"), F.lit(0)).cast("double").alias("keyword_freq"),
    ).withColumn("_density", F.col("keyword_freq") / F.col("review_count").cast("double"))

    scored = attach_scalars(
        grouped,
        F.min("review_count").alias("_min_n"),
        F.max("review_count").alias("_max_n"),
        F.max(F.when(F.col("_density") >= F.lit(threshold), F.col("_density"))).alias("_max_density"),
    )

    def popularity(count: str) -> Column:
        return F.round(min_max_scaled(F.col(count), F.col("_min_n"), F.col("_max_n"), 100.0), 2)

    keep = F.col("_density") >= F.lit(threshold)

    if tuple(join_keys) == ("item", "grp"):
        ranked = scored.where(keep).withColumn("_popularity", popularity("review_count"))
    elif tuple(join_keys) == ("item",):
        # Each kept pair with every popularity of its item: the grouped table joined with itself,
        # so that no task holds an item as a list and AQE can split a hot one. A NULL item joins
        # nothing. The other side keeps the hits (never negative) and its key is a struct, from
        # which no filter on items follows: both sides are then one exchange, one read of the texts.
        others = grouped.where(F.col("keyword_freq") >= F.lit(0.0)).select(
            F.struct("item").alias("_other"), F.col("review_count").alias("_count")
        )
        own = scored.where(keep).withColumn("_own", F.when(F.col("item").isNotNull(), F.struct("item")))
        ranked = own.join(others, F.col("_own") == F.col("_other"), "left").withColumn("_popularity", popularity("_count"))
    else:
        raise ValueError("join_keys must be ('item', 'grp') or ('item',)")

    relevance = F.round(
        F.col("_density") / F.greatest(F.col("_max_density"), F.lit(DENSITY_FLOOR)) * F.lit(100.0), 2
    )
    ranked = ranked.withColumn("relevance_score", relevance).withColumn(
        "final_score",
        F.round(
            F.col("relevance_score") * F.lit(RELEVANCE_WEIGHT)
            + F.coalesce(F.col("_popularity"), F.lit(0.0)) * F.lit(POPULARITY_WEIGHT),
            2,
        ),
    )
    if grp is not None and group_filter_stage == "before":
        ranked = ranked.where(F.col("grp") == F.lit(grp))
    top = ranked.orderBy(*desc_keys("final_score", "item", "grp")).limit(n)
    if grp is not None and group_filter_stage == "after":
        top = top.where(F.col("grp") == F.lit(grp))
    if min_final_score is not None:
        top = top.where(F.col("final_score") >= F.lit(float(min_final_score)))
    return top.select(*RANKING_COLUMNS).orderBy(*desc_keys("final_score", "item", "grp"))


def ranking_summary(result: DataFrame, score_col: str = "relevance_score") -> DataFrame:
    """One row: result_count, avg_score (mean of ``score_col``, 4 dp), groups_covered."""
    return result.agg(
        F.count(F.lit(1)).alias("result_count"),
        F.round(F.avg(score_col), 4).alias("avg_score"),
        F.count_distinct("grp").alias("groups_covered"),
    )


def score_by_group(result: DataFrame, score_col: str = "final_score") -> DataFrame:
    """Score total per group of a result (the share each group takes):
    (grp, total_score), rounded to 2 dp, largest first."""
    out = result.groupBy("grp").agg(F.round(F.sum(score_col), 2).alias("total_score"))
    return out.orderBy(*desc_keys("total_score", "grp"))


SCORE_PREFERENCE = ("final_score", "relevance_score", "popularity_score", "hybrid_score", "stars", "avg_stars")
TIE_KEYS = ("item", "grp", "listing_id", "room_type")
# Lists ordered by stars show larger places first among equal stars.
SECOND_SCORES = {"stars": ("guests",)}


def top_recommendation(result: DataFrame, score_cols: Sequence[str] = SCORE_PREFERENCE) -> DataFrame:
    """The first shown row of a ranking or recommendation result, with ``score`` = the first of
    ``score_cols`` the result has (final -> relevance -> popularity for place rankings, hybrid
    score or stars for listings, average stars for room types). Ties are broken as the list
    itself orders them: by guests where it is ordered by stars, then by the key columns."""
    present = [c for c in score_cols if c in result.columns]
    if not present:
        raise ValueError(f"none of {list(score_cols)} in {result.columns}")
    second = [F.col(c).desc_nulls_last() for c in SECOND_SCORES.get(present[0], ()) if c in result.columns]
    keys = [F.col(k).asc_nulls_first() for k in TIE_KEYS if k in result.columns and (k != "room_type" or "listing_id" not in result.columns)]
    scored = result.withColumn("score", F.col(present[0]).cast("double"))
    return scored.orderBy(F.col("score").desc_nulls_last(), *second, *keys).limit(1)


def display_columns(result: DataFrame, kind: str) -> DataFrame:
    """Project a result to its display columns, renamed, in display order."""
    names = DISPLAY_NAMES[kind]
    return result.select([F.col(c).alias(label) for c, label in names.items()])
