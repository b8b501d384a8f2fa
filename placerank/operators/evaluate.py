"""Evaluation of any recommendation list: Precision@K, counts and catalogue coverage.

One aggregate over the recommendations (count, conditional count) and one over the
catalogue (count), each a single row, side by side: one action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attach_stats
from ..schema import require_columns
from .recommend import CATALOGUE_SIZE

# Fixed values of the reference's evaluation and its precision gauge.
RELEVANT_MIN_STARS = 4.0
PRECISION_TARGET_PCT = 70.0  # the gauge's threshold line
PRECISION_BANDS = ((40.0, "0-40"), (70.0, "40-70"))  # upper bound (exclusive), label
TOP_BAND = "70-100"


def evaluate_recommendations(recs: DataFrame, listings: DataFrame | None, num_guests: int,
                             min_stars: float = RELEVANT_MIN_STARS,
                             room_type: str | None = None) -> DataFrame:
    """One row: precision_at_k, total_recommended, relevant_count, coverage (percent of
    all listings recommended), precision_pct, precision_band, precision_target_pct (the
    gauge's threshold). The catalogue's size is taken from ``recs`` where these carry it
    (``hybrid_recommendations(keep_size=True)``), else counted from ``listings``.

    A recommendation is relevant when its stars reach ``min_stars`` and it holds
    ``num_guests``; passing ``room_type`` also requires the type to match (substring,
    case-insensitive, "Any" = no check). An empty list gives zeros, as in the reference.
    """
    require_columns(recs, "stars", "guests")
    relevant = (F.col("stars") >= F.lit(float(min_stars))) & (F.col("guests") >= F.lit(num_guests))
    if room_type is not None and room_type != "Any":
        require_columns(recs, "room_type")
        relevant = relevant & F.lower(F.col("room_type")).contains(room_type.lower())
    size = [F.max(CATALOGUE_SIZE).alias("_all_listings")] if CATALOGUE_SIZE in recs.columns else []
    rec_stats = recs.agg(
        F.count(F.lit(1)).alias("total_recommended"),
        F.count_if(relevant).alias("relevant_count"),
        *size,
    )
    if CATALOGUE_SIZE in recs.columns:
        both = rec_stats
    else:
        if listings is None:
            raise ValueError(f"listings are needed where the recommendations have no {CATALOGUE_SIZE}")
        both = attach_stats(rec_stats, listings, F.count(F.lit(1)).alias("_all_listings"))
    precision = F.coalesce(
        F.round(F.try_divide(F.col("relevant_count").cast("double"), F.col("total_recommended").cast("double")), 2),
        F.lit(0.0),
    )
    coverage = F.when(
        F.col("total_recommended") > 0,
        F.round(
            F.try_divide(F.col("total_recommended").cast("double"), F.col("_all_listings").cast("double"))
            * F.lit(100.0),
            2,
        ),
    ).otherwise(F.lit(0.0))
    out = both.select(
        precision.alias("precision_at_k"),
        "total_recommended",
        "relevant_count",
        F.coalesce(coverage, F.lit(0.0)).alias("coverage"),
    )
    pct = F.col("precision_at_k") * F.lit(100.0)
    band = F.when(pct < F.lit(PRECISION_BANDS[0][0]), F.lit(PRECISION_BANDS[0][1]))
    for bound, label in PRECISION_BANDS[1:]:
        band = band.when(pct < F.lit(bound), F.lit(label))
    band = band.otherwise(F.lit(TOP_BAND))
    return out.withColumn("precision_pct", pct).withColumn("precision_band", band).withColumn(
        "precision_target_pct", F.lit(PRECISION_TARGET_PCT)
    )
