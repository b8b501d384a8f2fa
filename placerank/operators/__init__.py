"""DataFrame -> DataFrame operators. None calls an action, except the MLlib fits
(``cluster_items``, ``tfidf_vectors``, ``listing_features``), which must."""

from .aggregate import (
    distinct_items_per_group,
    group_counts,
    group_options,
    group_shares,
    period_trend,
    top_items,
    value_options,
)
from .clean import clean_listings, observed_clean_listings, rejection_counts
from .cluster import (
    best_cuts,
    cluster_cost,
    cluster_items,
    cluster_samples,
    cluster_summary,
    label_clusters,
    optimal_clusters,
)
from .evaluate import evaluate_recommendations
from .profile import compare_profiles, listings_overview, merged_overview, overview_sketches, posts_overview, profile
from .recommend import (
    content_recommendations,
    hybrid_recommendations,
    hybrid_scored,
    listing_feature_arrays,
    listing_feature_columns,
    listing_feature_vectors,
    listing_features,
    recommendation_summary,
    room_type_distribution,
    room_type_ranking,
    room_types,
    score_breakdown,
)
from .scoring import (
    avg_popularity_by_group,
    browse_popular,
    item_counts,
    popularity_of_counts,
    popularity_score,
    rank_within,
    scored_counts,
    summed_counts,
    top_popular,
)
from .search import (
    display_columns,
    keyword_ranking,
    ranking_summary,
    score_by_group,
    top_recommendation,
)
from .text import (
    heavy_top_words,
    tfidf_buckets,
    tfidf_sparse_vectors,
    tfidf_terms,
    tfidf_vectors,
    top_tfidf_terms,
    top_words,
    word_frequency_map,
)

__all__ = [
    "best_cuts",
    "cluster_cost",
    "optimal_clusters",
    "avg_popularity_by_group",
    "browse_popular",
    "clean_listings",
    "cluster_items",
    "cluster_samples",
    "cluster_summary",
    "compare_profiles",
    "content_recommendations",
    "display_columns",
    "distinct_items_per_group",
    "evaluate_recommendations",
    "group_counts",
    "group_options",
    "group_shares",
    "heavy_top_words",
    "hybrid_recommendations",
    "hybrid_scored",
    "item_counts",
    "keyword_ranking",
    "label_clusters",
    "listing_feature_arrays",
    "listing_feature_columns",
    "listing_feature_vectors",
    "listing_features",
    "listings_overview",
    "merged_overview",
    "observed_clean_listings",
    "overview_sketches",
    "period_trend",
    "popularity_of_counts",
    "popularity_score",
    "posts_overview",
    "profile",
    "rank_within",
    "ranking_summary",
    "recommendation_summary",
    "rejection_counts",
    "room_type_distribution",
    "room_type_ranking",
    "room_types",
    "score_breakdown",
    "summed_counts",
    "score_by_group",
    "scored_counts",
    "tfidf_buckets",
    "tfidf_sparse_vectors",
    "tfidf_terms",
    "tfidf_vectors",
    "top_items",
    "top_popular",
    "top_recommendation",
    "top_tfidf_terms",
    "top_words",
    "value_options",
    "word_frequency_map",
]
