"""Named queries: a binding of the shared test tables plus one operator, with the
parameters of SURVEY §7.5. Each takes (spark, sf_dir) and returns a lazy DataFrame.

``__spark_entry__.queries()`` exposes this dictionary; ``plans.oracle`` holds the DuckDB
SQL of the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..session import shared_path
from ..sources import (
    bindings,
    catalogue_bounds,
    read_listings,
    read_posts,
    write_bucketed,
    write_catalogue,
    write_csv,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
KEYWORDS = ("und", "pour")
PATTERNS = ("und", "po.r")
MIN_FINAL_SCORE = 50.0
EVALUATED_ROOM_TYPE = "small"
TOP_ITEMS_N = 15
TOP_POPULAR_N = 15
TOP_POPULAR_WIDE_N = 50  # the dashboard's scatter of the first 50
BROWSE_MIN_SCORE = 10.0
BROWSE_N = 10
TOP_WORDS_N = 20
WORD_MAP_N = 100
TOP_TERMS_N = 10
RANKING_N = 10
CONTENT_ARGS = ("small", 2, 10)  # room type, guests, n
HYBRID_ARGS = ("Any", 2, 4.0, 10)  # room type, guests, min stars, n
HYBRID_TYPED_ARGS = ("small", 3, 3.5, 10)  # with a room-type filter
ROOM_RANKING_N = 10
KMEANS_K = 4
HASHED_FEATURES = 1000
SAMPLES_N = 5
SCORE_BAND_WIDTH = 25.0  # deterministic cluster ids (score bands) for the label oracle checks
SCORE_BANDS = 4
GROUP_FILTER = "de"  # a group of the documents table, for the group-filtered variants
GROUP_FIRST_FILTER = "fr"  # a group outside the overall top-n, filtered before the top-n


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_listings(bindings.listings_raw(spark, sf_dir))


def _keyword_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.keyword_ranking(bindings.posts(spark, sf_dir), KEYWORDS, n=RANKING_N)


def _hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    room, guests, min_stars, n = HYBRID_ARGS
    return op.hybrid_recommendations(_listings(spark, sf_dir), room, guests, min_stars, n)


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    room, guests, n = CONTENT_ARGS
    return op.content_recommendations(_listings(spark, sf_dir), room, guests, n)


def _room_types_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.room_type_ranking(_listings(spark, sf_dir), ROOM_RANKING_N)


def _evaluated_hybrid(spark: SparkSession, sf_dir: str, room_type: str | None = None) -> DataFrame:
    recs = op.hybrid_recommendations(_listings(spark, sf_dir), *HYBRID_ARGS, keep_size=True)
    return op.evaluate_recommendations(recs, None, HYBRID_ARGS[1], room_type=room_type)


def _fixed_clusters(spark: SparkSession, sf_dir: str, binding: Query = bindings.sales) -> DataFrame:
    """Popularity (of sales by default) with deterministic cluster ids -- equal-width bands of the score,
    a fixed one-dimensional grouping -- to check the labelling and summary operators
    against SQL independently of K-Means' numeric result."""
    pop = op.popularity_score(binding(spark, sf_dir))
    band = F.least(F.floor(F.col("popularity_score") / F.lit(SCORE_BAND_WIDTH)), F.lit(SCORE_BANDS - 1))
    with_ids = pop.withColumn("prediction", band.cast("int"))
    return op.label_clusters(with_ids.select("item", "grp", "review_count", "popularity_score", "prediction"))


CSV_KEPT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _posts_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts written as CSV with quoted line breaks and read back in splits."""
    path = shared_path(spark, "posts-csv")
    write_csv(bindings.posts(spark, sf_dir), path)
    return read_posts(spark, path, fmt="csv", options=CSV_KEPT, multiline="split")


def _listings_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uncleaned listings written as CSV, read back in splits and cleaned."""
    path = shared_path(spark, "listings-csv")
    write_csv(bindings.listings_raw(spark, sf_dir), path)
    return op.clean_listings(read_listings(spark, path, fmt="csv", options=CSV_KEPT, multiline="split"))


def _overview_by_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each period written as a table, and the overview of all periods from it."""
    path = shared_path(spark, "overview-sketches")
    write_table(op.overview_sketches(bindings.posts_raw(spark, sf_dir)), path)
    return op.merged_overview(spark.read.parquet(path))


COUNT_BUCKETS = 32


def _popularity_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per pair stored in a bucketed table, and the popularity from that table."""
    path = shared_path(spark, "pair_counts")
    counts = op.item_counts(bindings.posts_raw(spark, sf_dir))
    table = f"pair_counts_{path.rsplit('-', 1)[1]}"
    stored = write_bucketed(counts, table, path, ("item", "grp"), COUNT_BUCKETS)
    return op.popularity_of_counts(op.summed_counts(stored))


def _catalogue(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "catalogue")
    write_catalogue(_listings(spark, sf_dir), path)
    return path


QUERIES: dict[str, Query] = {
    # sources
    "posts_from_csv": _posts_from_csv,
    "listings_from_csv": _listings_from_csv,
    # counting (posts)
    "top_items": lambda s, d: op.top_items(bindings.posts(s, d), TOP_ITEMS_N),
    "group_counts": lambda s, d: op.group_counts(bindings.posts(s, d)),
    "group_shares": lambda s, d: op.group_shares(bindings.posts(s, d)),
    "period_trend": lambda s, d: op.period_trend(bindings.posts(s, d)),
    "distinct_items_per_group": lambda s, d: op.distinct_items_per_group(bindings.posts(s, d)),
    "posts_overview": lambda s, d: op.posts_overview(bindings.posts(s, d)),
    "posts_overview_sketches": _overview_by_sketches,
    "group_options": lambda s, d: op.group_options(bindings.posts(s, d)),
    "cleaning_comparison": lambda s, d: op.compare_profiles(bindings.posts_raw(s, d), bindings.posts(s, d)),
    # tables laid out for their readers
    "popularity_score_stored": _popularity_stored,
    "catalogue_bounds": lambda s, d: catalogue_bounds(s, _catalogue(s, d)),
    # popularity
    "popularity_score": lambda s, d: op.popularity_score(bindings.posts(s, d)),
    "popularity_score_sales": lambda s, d: op.popularity_score(bindings.sales(s, d)),
    "top_popular": lambda s, d: op.top_popular(op.popularity_score(bindings.posts(s, d)), TOP_POPULAR_N),
    "top_popular_50": lambda s, d: op.top_popular(op.popularity_score(bindings.posts(s, d)), TOP_POPULAR_WIDE_N),
    "browse_popular": lambda s, d: op.browse_popular(
        op.popularity_score(bindings.posts(s, d)), None, BROWSE_MIN_SCORE, BROWSE_N
    ),
    "browse_popular_in_group": lambda s, d: op.browse_popular(
        op.popularity_score(bindings.posts(s, d)), GROUP_FILTER, BROWSE_MIN_SCORE, BROWSE_N
    ),
    "browse_summary": lambda s, d: op.ranking_summary(
        op.browse_popular(op.popularity_score(bindings.posts(s, d)), None, BROWSE_MIN_SCORE, BROWSE_N),
        "popularity_score",
    ),
    "browse_score_by_group": lambda s, d: op.score_by_group(
        op.browse_popular(op.popularity_score(bindings.posts(s, d)), None, BROWSE_MIN_SCORE, BROWSE_N),
        "popularity_score",
    ),
    "avg_popularity_by_group": lambda s, d: op.avg_popularity_by_group(op.popularity_score(bindings.posts(s, d))),
    # with NULL items and groups
    "avg_popularity_by_group_raw": lambda s, d: op.avg_popularity_by_group(
        op.popularity_score(bindings.posts_raw(s, d))
    ),
    "cluster_summary_raw": lambda s, d: op.cluster_summary(_fixed_clusters(s, d, bindings.posts_raw)),
    # words and TF-IDF
    "top_words": lambda s, d: op.top_words(bindings.posts(s, d), TOP_WORDS_N),
    "top_words_heavy": lambda s, d: op.heavy_top_words(bindings.posts(s, d), TOP_WORDS_N),
    "word_frequency_map": lambda s, d: op.word_frequency_map(
        op.top_words(bindings.posts(s, d), WORD_MAP_N), WORD_MAP_N
    ).select(F.to_json("word_freq").alias("word_freq_json")),
    "tfidf_terms": lambda s, d: op.tfidf_terms(bindings.posts(s, d)),
    "top_tfidf_terms": lambda s, d: op.top_tfidf_terms(op.tfidf_terms(bindings.posts(s, d)), TOP_TERMS_N),
    "tfidf_vectors": lambda s, d: op.tfidf_vectors(bindings.posts(s, d)),
    "tfidf_buckets": lambda s, d: op.tfidf_buckets(bindings.posts(s, d), HASHED_FEATURES, buckets="md5"),
    # keyword ranking and its result summaries
    "keyword_ranking": _keyword_result,
    "keyword_ranking_item_join": lambda s, d: op.keyword_ranking(
        bindings.posts(s, d), KEYWORDS, n=RANKING_N, join_keys=("item",)
    ),
    "keyword_ranking_in_group": lambda s, d: op.keyword_ranking(
        bindings.posts(s, d), KEYWORDS, n=RANKING_N, grp=GROUP_FILTER
    ),
    "keyword_ranking_group_first": lambda s, d: op.keyword_ranking(
        bindings.posts(s, d), KEYWORDS, n=RANKING_N, grp=GROUP_FIRST_FILTER, group_filter_stage="before"
    ),
    "keyword_ranking_min_score": lambda s, d: op.keyword_ranking(
        bindings.posts(s, d), KEYWORDS, n=RANKING_N, min_final_score=MIN_FINAL_SCORE
    ),
    "keyword_ranking_regex": lambda s, d: op.keyword_ranking(
        bindings.posts(s, d), PATTERNS, n=RANKING_N, keyword_match="regex"
    ),
    "ranking_summary": lambda s, d: op.ranking_summary(_keyword_result(s, d)),
    "score_by_group": lambda s, d: op.score_by_group(_keyword_result(s, d)),
    "top_recommendation": lambda s, d: op.top_recommendation(_keyword_result(s, d)).select(
        "item", "grp", "score", "review_count"
    ),
    "display_columns": lambda s, d: op.display_columns(_keyword_result(s, d), "keyword"),
    "display_columns_popularity": lambda s, d: op.display_columns(
        op.browse_popular(op.popularity_score(bindings.posts(s, d)), None, BROWSE_MIN_SCORE, BROWSE_N),
        "popularity",
    ),
    # clustering
    "cluster_items": lambda s, d: op.cluster_items(op.popularity_score(bindings.sales(s, d)), KMEANS_K),
    "cluster_items_optimal": lambda s, d: op.optimal_clusters(op.popularity_score(bindings.sales(s, d)), KMEANS_K),
    "cluster_cost": lambda s, d: op.cluster_cost(op.optimal_clusters(op.popularity_score(bindings.sales(s, d)), KMEANS_K)),
    "label_clusters": _fixed_clusters,
    "cluster_summary": lambda s, d: op.cluster_summary(_fixed_clusters(s, d)),
    "cluster_samples": lambda s, d: op.cluster_samples(_fixed_clusters(s, d), SAMPLES_N),
    # listings
    "clean_listings": _listings,
    "listings_rejected": lambda s, d: op.rejection_counts(bindings.listings_raw(s, d)),
    "listings_overview": lambda s, d: op.listings_overview(_listings(s, d)),
    "room_types": lambda s, d: op.room_types(_listings(s, d)),
    "listing_feature_columns": lambda s, d: op.listing_feature_columns(_listings(s, d)),
    "listing_features": lambda s, d: op.listing_feature_arrays(_listings(s, d)),
    "listing_feature_vectors": lambda s, d: op.listing_feature_vectors(_listings(s, d)).select(
        "listing_id", "room_type_index",
        *[F.element_at("feature_vector", i).alias(f"feature_{i}") for i in (1, 2, 3)],
        *[F.round(F.element_at("normalised_features", i), 9).alias(f"normalised_{i}") for i in (1, 2, 3)],
    ),
    # recommendations
    "content_recommendations": _content,
    "room_type_ranking": _room_types_ranked,
    "room_type_summary": lambda s, d: op.recommendation_summary(_room_types_ranked(s, d)),
    "room_type_top": lambda s, d: op.top_recommendation(_room_types_ranked(s, d)),
    "content_top_listing": lambda s, d: op.top_recommendation(_content(s, d)).select(
        "listing_id", "name", "room_type", "guests", "stars", "score"
    ),
    "hybrid_recommendations": _hybrid,
    "hybrid_recommendations_typed": lambda s, d: op.hybrid_recommendations(_listings(s, d), *HYBRID_TYPED_ARGS),
    "score_breakdown": lambda s, d: op.score_breakdown(_listings(s, d), *HYBRID_ARGS),
    "recommendation_summary": lambda s, d: op.recommendation_summary(_hybrid(s, d)),
    "top_listing": lambda s, d: op.top_recommendation(_hybrid(s, d)).select(
        "listing_id", "name", "room_type", "guests", "stars", "score"
    ),
    "room_type_distribution": lambda s, d: op.room_type_distribution(_hybrid(s, d)),
    "content_summary": lambda s, d: op.recommendation_summary(_content(s, d)),
    "content_room_type_distribution": lambda s, d: op.room_type_distribution(_content(s, d)),
    "evaluate_hybrid": _evaluated_hybrid,
    "evaluate_hybrid_room_type": lambda s, d: _evaluated_hybrid(s, d, EVALUATED_ROOM_TYPE),
    "evaluate_content": lambda s, d: op.evaluate_recommendations(_content(s, d), _listings(s, d), CONTENT_ARGS[1]),
}
