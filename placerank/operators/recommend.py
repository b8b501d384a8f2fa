"""Offer recommendation over cleaned listings: content filter, popularity by room type,
the hybrid score, and the summaries a results page shows.

All per-request statistics (min/max stars of the candidate set, totals) are one-row
global aggregates broadcast back to the candidate rows, so each request is one lazy plan
and one action; top-k is TakeOrderedAndProject with ``listing_id`` as the last tie-break.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Normalizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attach_scalars, attach_stats, min_max_scaled
from ..schema import require_columns
from .aggregate import value_options
from .ordering import ordinal

# Fixed values of the reference's recommender.
ANY_ROOM_TYPE = "Any"  # the room-type choice that disables the type filter
STARS_WEIGHT = 0.7
MATCH_WEIGHT = 0.3
EXACT_MATCH_SCORE = 1.0  # capacity equals the party size
NEAR_MATCH_SCORE = 0.8  # capacity at most two above
FAR_MATCH_SCORE = 0.5
NEAR_MATCH_SLACK = 2
RANGE_EPSILON = 0.001  # added to the star range of the candidate set
DEFAULT_MIN_STARS_FLOOR = 0.0  # used when the candidate minimum is missing or zero
DEFAULT_MAX_STARS_CEIL = 5.0  # used when the candidate maximum is missing or zero

LISTING_COLUMNS = ["listing_id", "name", "room_type", "guests", "stars"]
CATALOGUE_SIZE = "catalogue_size"  # listings in the whole catalogue, on each scored row
HYBRID_COLUMNS = LISTING_COLUMNS + ["guest_match_score", "hybrid_score"]


def _room_type_matches(preferred_room_type: str | None) -> Column:
    """Case-insensitive literal substring match on the room type; "Any" keeps all."""
    if preferred_room_type is None or preferred_room_type == ANY_ROOM_TYPE:
        return F.lit(True)
    return F.lower(F.col("room_type")).contains(preferred_room_type.lower())


def content_recommendations(listings: DataFrame, preferred_room_type: str, num_guests: int,
                            n: int = 10) -> DataFrame:
    """Listings of the wanted type that hold the party, best stars then largest capacity."""
    require_columns(listings, *LISTING_COLUMNS)
    cand = listings.where(_room_type_matches(preferred_room_type) & (F.col("guests") >= F.lit(num_guests)))
    return cand.orderBy(
        F.col("stars").desc_nulls_last(), F.col("guests").desc_nulls_last(), F.col("listing_id")
    ).limit(n).select(*LISTING_COLUMNS)


def room_type_ranking(listings: DataFrame, n: int = 10) -> DataFrame:
    """Popularity by room type: (room_type, avg_stars, listing_count, max_stars), best
    average first."""
    require_columns(listings, "room_type", "stars")
    agg = listings.groupBy("room_type").agg(
        F.round(F.avg(F.col("stars").cast("double")), 2).alias("avg_stars"),
        F.count(F.lit(1)).alias("listing_count"),
        F.round(F.max("stars"), 2).alias("max_stars"),
    )
    return agg.orderBy(F.col("avg_stars").desc_nulls_last(), F.col("room_type").asc_nulls_first()).limit(n)


def guest_match_score(guests: Column, num_guests: int) -> Column:
    return (
        F.when(guests == F.lit(num_guests), F.lit(EXACT_MATCH_SCORE))
        .when(guests <= F.lit(num_guests + NEAR_MATCH_SLACK), F.lit(NEAR_MATCH_SCORE))
        .otherwise(F.lit(FAR_MATCH_SCORE))
    )


def hybrid_scored(listings: DataFrame, preferred_room_type: str, num_guests: int,
                  min_stars: float = 4.0, keep_size: bool = False) -> DataFrame:
    """Every candidate with ``stars_norm``, ``guest_match_score`` and ``hybrid_score``
    (not limited). The star range is taken over the candidates only. ``keep_size`` adds the
    number of listings in the whole catalogue."""
    require_columns(listings, *LISTING_COLUMNS)
    fits = (F.col("stars") >= F.lit(float(min_stars))) & (F.col("guests") >= F.lit(num_guests))
    fits = fits & _room_type_matches(preferred_room_type)
    candidates = listings.where(fits)
    if keep_size:
        # One aggregate over the whole catalogue gives the candidates' star range and its size.
        with_stats = attach_stats(
            candidates,
            listings,
            F.min(F.when(fits, F.col("stars"))).alias("_min_s"),
            F.max(F.when(fits, F.col("stars"))).alias("_max_s"),
            F.count(F.lit(1)).alias(CATALOGUE_SIZE),
        )
    else:
        with_stats = attach_scalars(candidates, F.min("stars").alias("_min_s"), F.max("stars").alias("_max_s"))
    lo = F.col("_min_s").cast("double")
    hi = F.col("_max_s").cast("double")
    lo = F.when(lo.isNull() | (lo == F.lit(0.0)), F.lit(DEFAULT_MIN_STARS_FLOOR)).otherwise(lo)
    hi = F.when(hi.isNull() | (hi == F.lit(0.0)), F.lit(DEFAULT_MAX_STARS_CEIL)).otherwise(hi)
    stars_norm = (F.col("stars").cast("double") - lo) / (hi - lo + F.lit(RANGE_EPSILON))
    match = guest_match_score(F.col("guests"), num_guests)
    return (
        with_stats.withColumn("stars_norm", stars_norm)
        .withColumn("guest_match_score", match)
        .withColumn(
            "hybrid_score",
            F.round(F.col("stars_norm") * F.lit(STARS_WEIGHT) + F.col("guest_match_score") * F.lit(MATCH_WEIGHT), 4),
        )
        .drop("_min_s", "_max_s")
    )


def _top_hybrid(scored: DataFrame, n: int) -> DataFrame:
    return scored.orderBy(F.col("hybrid_score").desc_nulls_last(), F.col("listing_id")).limit(n)


def hybrid_recommendations(listings: DataFrame, preferred_room_type: str, num_guests: int,
                           min_stars: float = 4.0, n: int = 10, keep_size: bool = False) -> DataFrame:
    """Top ``n`` by ``0.7 * stars_norm + 0.3 * guest_match_score`` (rounded to 4).
    ``keep_size`` adds the number of listings in the catalogue, for ``evaluate_recommendations``."""
    scored = hybrid_scored(listings, preferred_room_type, num_guests, min_stars, keep_size)
    return _top_hybrid(scored, n).select(*HYBRID_COLUMNS, *([CATALOGUE_SIZE] if keep_size else []))


def score_breakdown(listings: DataFrame, preferred_room_type: str, num_guests: int,
                    min_stars: float = 4.0, n: int = 10) -> DataFrame:
    """The two weighted parts of each recommended listing's hybrid score:
    (listing_id, name, stars_part, match_part, hybrid_score). The star part uses the
    normalised stars, so the parts add up to the score before its rounding."""
    scored = hybrid_scored(listings, preferred_room_type, num_guests, min_stars)
    return _top_hybrid(scored, n).select(
        "listing_id",
        "name",
        (F.col("stars_norm") * F.lit(STARS_WEIGHT)).alias("stars_part"),
        (F.col("guest_match_score") * F.lit(MATCH_WEIGHT)).alias("match_part"),
        "hybrid_score",
    )


def recommendation_summary(recs: DataFrame) -> DataFrame:
    """One row: total_recommendations, avg_stars (2 dp), top_stars, avg_hybrid_score
    (3 dp; NULL when the recommendations carry no hybrid score). A ranking of room types
    has no stars of its own: its count, and NULLs."""
    has_stars, has_hybrid = "stars" in recs.columns, "hybrid_score" in recs.columns
    stars = F.round(F.avg(F.col("stars").cast("double")), 2) if has_stars else F.lit(None).cast("double")
    hybrid = F.round(F.avg("hybrid_score"), 3) if has_hybrid else F.lit(None).cast("double")
    return recs.agg(
        F.count(F.lit(1)).alias("total_recommendations"),
        stars.alias("avg_stars"),
        (F.max("stars") if has_stars else F.lit(None).cast("float")).alias("top_stars"),
        hybrid.alias("avg_hybrid_score"),
    )


def room_type_distribution(recs: DataFrame) -> DataFrame:
    """How many recommendations per room type: (room_type, listing_count). As in pandas'
    ``value_counts``, a NULL type is not listed."""
    out = recs.where(F.col("room_type").isNotNull()).groupBy("room_type").agg(F.count(F.lit(1)).alias("listing_count"))
    return out.orderBy(F.col("listing_count").desc(), F.col("room_type").asc_nulls_first())


def room_types(listings: DataFrame) -> DataFrame:
    """Sorted distinct room types with "Any" first: (room_type)."""
    return value_options(listings, "room_type", ANY_ROOM_TYPE)


# The buckets' bounds follow the reference.
def guest_bucket(guests: Column) -> Column:
    """1 guest -> 1, 2 -> 2, 3-4 -> 3, 5 or more -> 4, anything else -> 1."""
    return (
        F.when(guests == 1, 1)
        .when(guests == 2, 2)
        .when(guests.between(3, 4), 3)
        .when(guests >= 5, 4)
        .otherwise(1)
    )


def listing_feature_columns(listings: DataFrame) -> DataFrame:
    """The listing features as plain columns: (listing_id, guest_bucket, stars_normalised,
    room_type_index).

    ``stars_normalised`` is min-max over all listings (NULL when all stars are equal).
    ``room_type_index`` follows ``StringIndexer``: labels by frequency descending, ties
    alphabetical, NULL (unseen) -> the number of labels.

    The label dictionary is one aggregate row per room type. It is numbered with
    ``ordinal`` (range partitions plus per-partition offsets, written once, no single-task window) in
    the order (NULL last, frequency descending, label): the NULL row then gets exactly the
    number of labels. It is joined back null-safely, so every listing matches one entry;
    AQE broadcasts the dictionary when its measured size allows. Min/max stars are a
    one-row aggregate broadcast back.
    """
    require_columns(listings, *LISTING_COLUMNS)
    labels = listings.groupBy("room_type").agg(F.count(F.lit(1)).alias("_freq"))
    order = [F.col("room_type").isNull().asc(), F.col("_freq").desc(), F.col("room_type").asc()]
    dictionary = ordinal(labels, order, "_position").select(
        F.col("room_type").alias("_label"), F.col("_position").cast("int").alias("_index")
    )
    with_stats = attach_scalars(listings, F.min("stars").alias("_min_s"), F.max("stars").alias("_max_s"))
    indexed = with_stats.join(dictionary, with_stats["room_type"].eqNullSafe(dictionary["_label"]), "inner")
    return indexed.select(
        "listing_id",
        guest_bucket(F.col("guests")).alias("guest_bucket"),
        min_max_scaled(F.col("stars"), F.col("_min_s"), F.col("_max_s")).alias("stars_normalised"),
        F.col("_index").alias("room_type_index"),
    )


def listing_features(listings: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """MLlib feature vectors: ``StringIndexer`` (keep invalid) -> ``VectorAssembler``
    (room_type_index, guest_bucket, stars_normalised) -> L2 ``Normalizer``; returns the
    rows with ``feature_vector`` and ``normalised_features`` and the fitted model.
    A NULL ``stars_normalised`` (all stars equal) enters the vector as 0.0, because the
    assembler rejects NULL."""
    require_columns(listings, *LISTING_COLUMNS)
    with_stats = attach_scalars(listings, F.min("stars").alias("_min_s"), F.max("stars").alias("_max_s"))
    base = with_stats.select(
        *LISTING_COLUMNS,
        guest_bucket(F.col("guests")).alias("guest_bucket"),
        F.coalesce(min_max_scaled(F.col("stars"), F.col("_min_s"), F.col("_max_s")), F.lit(0.0))
        .alias("stars_normalised"),
    )
    pipeline = Pipeline(
        stages=[
            StringIndexer(inputCol="room_type", outputCol="room_type_index", handleInvalid="keep"),
            VectorAssembler(
                inputCols=["room_type_index", "guest_bucket", "stars_normalised"],
                outputCol="feature_vector",
            ),
            Normalizer(inputCol="feature_vector", outputCol="normalised_features", p=2.0),
        ]
    )
    model = pipeline.fit(base)
    return model.transform(base), model


def listing_feature_arrays(listings: DataFrame) -> DataFrame:
    """``listing_features`` with the vectors as ``array<double>``: (listing_id,
    room_type_index, feature_vector, normalised_features)."""
    featured, _ = listing_features(listings)
    return featured.select(
        "listing_id",
        F.col("room_type_index").cast("int").alias("room_type_index"),
        vector_to_array("feature_vector").alias("feature_vector"),
        vector_to_array("normalised_features").alias("normalised_features"),
    )


def listing_feature_vectors(listings: DataFrame) -> DataFrame:
    """The feature vectors from ``listing_feature_columns``: (listing_id, room_type_index,
    feature_vector, normalised_features), arrays of three doubles (room_type_index, guest_bucket,
    stars_normalised; NULL stars as 0.0) and the same divided by their length (a zero vector stays
    zero). Equal to ``listing_feature_arrays``, but the labels are a written table that is joined:
    no label array on the driver, however many room types there are."""
    columns = listing_feature_columns(listings)
    raw = columns.select("listing_id", "room_type_index", F.array(
        F.col("room_type_index").cast("double"), F.col("guest_bucket").cast("double"), F.coalesce("stars_normalised", F.lit(0.0))
    ).alias("feature_vector"))
    v = [F.element_at("feature_vector", i) for i in (1, 2, 3)]
    length = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    unit = F.transform("feature_vector", lambda x: F.when(length > 0, x / length).otherwise(x))
    return raw.withColumn("normalised_features", unit)
