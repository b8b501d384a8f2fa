"""Profiles and overviews: several statistics of a table in one aggregate (one action, one
scan per input), instead of one action per number.

Distinct counts are exact by default (as in the reference). ``approx_rsd`` switches them to
HyperLogLog++ sketches, which merge partially per task: at scale an exact distinct count
shuffles every distinct value (and several in one aggregate expand the rows once per
column), a sketch shuffles a few kilobytes per task.

``overview_sketches`` keeps those sketches as columns of a table, one row per part (a day, a file,
a period), and ``merged_overview`` gives the overview of any set of parts from their rows alone:
new parts are added without reading the old posts again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import count_values_with_null, null_or_empty
from ..schema import require_columns

# The metric labels of the raw-against-clean comparison, in the reference's
# order (its items are "destinations" and its groups "districts").
PROFILE_METRICS = ("Total Rows", "Null Values", "Unique Destinations", "Unique Districts")


def profile(posts: DataFrame, item_col: str = "item", grp_col: str = "grp",
            approx_rsd: float | None = None) -> DataFrame:
    """One row: total_rows, null_values (NULL-or-empty cells over every column),
    unique_items and unique_groups (a NULL counts as one value)."""
    require_columns(posts, item_col, grp_col)
    null_cells = None
    for c in posts.columns:
        term = F.count_if(null_or_empty(F.col(f"`{c}`")))
        null_cells = term if null_cells is None else null_cells + term
    return posts.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (null_cells if null_cells is not None else F.lit(0)).cast("long").alias("null_values"),
        count_values_with_null(item_col, approx_rsd).alias("unique_items"),
        count_values_with_null(grp_col, approx_rsd).alias("unique_groups"),
    )


def compare_profiles(raw: DataFrame, clean: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """The raw-against-clean comparison: (metric, raw_value, clean_value), four rows in
    the fixed metric order. Each side is one global aggregate (one row); the two rows are
    put side by side and unpivoted with ``stack``."""
    fields = ("total_rows", "null_values", "unique_items", "unique_groups")
    r = profile(raw, approx_rsd=approx_rsd).select([F.col(x).alias(f"r_{x}") for x in fields])
    c = profile(clean, approx_rsd=approx_rsd).select([F.col(x).alias(f"c_{x}") for x in fields])
    both = r.crossJoin(F.broadcast(c))
    m = PROFILE_METRICS
    stacked = both.selectExpr(
        "stack(4, "
        f"0, '{m[0]}', r_total_rows, c_total_rows, "
        f"1, '{m[1]}', r_null_values, c_null_values, "
        f"2, '{m[2]}', r_unique_items, c_unique_items, "
        f"3, '{m[3]}', r_unique_groups, c_unique_groups"
        ") AS (metric_order, metric, raw_value, clean_value)"
    )
    return stacked.orderBy("metric_order").select("metric", "raw_value", "clean_value")


def posts_overview(posts: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """One row: total_posts, total_items, total_groups, total_periods (NULL is a value)."""
    require_columns(posts, "item", "grp", "period")
    return posts.agg(
        F.count(F.lit(1)).alias("total_posts"),
        count_values_with_null("item", approx_rsd).alias("total_items"),
        count_values_with_null("grp", approx_rsd).alias("total_groups"),
        count_values_with_null("period", approx_rsd).alias("total_periods"),
    )


SKETCH_LG_K = 12  # 4,096 registers: a relative standard deviation of about 1.6 %
_SKETCHED = ("item", "grp", "period")


def overview_sketches(posts: DataFrame, part: str = "period", lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One row per value of ``part`` (NULL is one): (part, n_posts, and for item, grp and period
    ``<c>_sketch`` BINARY of the values and ``<c>_null``, whether a NULL is among them). The
    sketches are built per task and merged after the shuffle; a row has at most a few kilobytes a
    column, however many posts its part has."""
    require_columns(posts, part, *_SKETCHED)
    # A sketch leaves empty strings out, here they are a value: every value gets a sign before it.
    sketches = [F.hll_sketch_agg(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(lg_k)).alias(f"{c}_sketch") for c in _SKETCHED]
    nulls = [F.max(F.col(c).isNull()).alias(f"{c}_null") for c in _SKETCHED]
    return posts.groupBy(F.col(part).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n_posts"), *sketches, *nulls)


def merged_overview(sketches: DataFrame) -> DataFrame:
    """The columns of ``posts_overview`` from rows of ``overview_sketches``, which may come from
    several tables (united), with sketches of different sizes. Rows of no part give zeros."""
    def values(c: str) -> Column:
        estimate = F.hll_sketch_estimate(F.hll_union_agg(F.col(f"{c}_sketch"), F.lit(True)))
        return F.coalesce(estimate, F.lit(0)) + F.coalesce(F.max(f"{c}_null").cast("int"), F.lit(0)).cast("long")

    return sketches.agg(
        F.coalesce(F.sum("n_posts"), F.lit(0)).alias("total_posts"),
        values("item").alias("total_items"),
        values("grp").alias("total_groups"),
        values("period").alias("total_periods"),
    )


def listings_overview(listings: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """One row: total_listings, unique_room_types (NULL is a value), avg_stars (rounded to
    2; NULL when there are no listings), max_guests."""
    require_columns(listings, "room_type", "stars", "guests")
    return listings.agg(
        F.count(F.lit(1)).alias("total_listings"),
        count_values_with_null("room_type", approx_rsd).alias("unique_room_types"),
        F.round(F.avg(F.col("stars").cast("double")), 2).alias("avg_stars"),
        F.max("guests").alias("max_guests"),
    )
