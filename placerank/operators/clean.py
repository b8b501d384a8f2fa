"""Catalogue cleaning: raw listing strings to typed, validated listings.

One projection and one filter, all built-in expressions: trim every string column,
accept stars only when they read as a plain decimal number, take the first run of digits
as the guest count (``try_cast`` turns an overflowing run into NULL instead of an ANSI
error), keep rows with both values and at least one guest. Writing the result as typed
parquet (``sources.write_table``) lets later star/guest predicates reach the row groups.

A rejected row has one reason, the first that holds of: stars that do not read as a number,
guests without a number that fits, no guest. ``rejection_counts`` counts them in one aggregate;
``observed_clean_listings`` counts them while the cleaned rows are written, in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import require_columns

# What a valid star rating and a guest count look like.
STARS_PATTERN = r"^\d+(\.\d+)?$"
GUESTS_PATTERN = r"(\d+)"

KEPT, REASONS = "kept", ("bad_stars", "bad_guests", "no_guests")


def _typed(raw: DataFrame) -> DataFrame:
    require_columns(raw, "listing_id", "name", "room_type", "guests_raw", "stars_raw")
    stars_txt = F.trim(F.col("stars_raw"))
    guests_txt = F.trim(F.col("guests_raw"))
    digits = F.regexp_extract(guests_txt, GUESTS_PATTERN, 1)
    return raw.select(
        F.col("listing_id"),
        F.trim(F.col("name")).alias("name"),
        F.trim(F.col("room_type")).alias("room_type"),
        F.when(digits != F.lit(""), digits.try_cast(T.IntegerType())).alias("guests"),
        F.when(stars_txt.rlike(STARS_PATTERN), stars_txt.try_cast(T.FloatType())).alias("stars"),
    )


def _reason() -> Column:
    """Why a typed row is rejected, or that it is kept."""
    return (
        F.when(F.col("stars").isNull(), REASONS[0])
        .when(F.col("guests").isNull(), REASONS[1])
        .when(F.col("guests") <= F.lit(0), REASONS[2])
        .otherwise(KEPT)
    )


def _counts() -> list[Column]:
    return [F.count_if(_reason() == F.lit(r)).alias(r) for r in (KEPT, *REASONS)]


def clean_listings(raw: DataFrame) -> DataFrame:
    """(listing_id, name, room_type, guests_raw, stars_raw) ->
    (listing_id, name, room_type, guests INT, stars FLOAT), invalid rows dropped."""
    return _typed(raw).where(F.col("stars").isNotNull() & (F.col("guests") > F.lit(0)))


def rejection_counts(raw: DataFrame) -> DataFrame:
    """(reason, listings): four rows, the kept ones first; a reason that never holds has 0, also
    over an empty table. One scan and a one-row aggregate, turned into rows."""
    one = _typed(raw).agg(*_counts())
    pairs = ", ".join(f"'{r}', {r}" for r in (KEPT, *REASONS))
    return one.selectExpr(f"stack({1 + len(REASONS)}, {pairs}) AS (reason, listings)")


def observed_clean_listings(raw: DataFrame, name: str = "listings_rejected") -> tuple[DataFrame, Observation]:
    """``clean_listings`` and an observation that holds the counts by reason once the rows have
    been written (or collected): no second pass over the raw rows. ``Observation.get`` waits for
    the first action."""
    seen = Observation(name)
    typed = _typed(raw).observe(seen, *_counts())
    return typed.where(F.col("stars").isNotNull() & (F.col("guests") > F.lit(0))), seen
