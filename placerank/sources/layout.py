"""Tables laid out for the queries that read them: bucketed count tables, a sorted catalogue.

**Bucketed counts.** ``write_bucketed`` writes rows into a fixed number of buckets by a hash of the
keys, sorted inside each file; sums per key and joins of tables with the same buckets then read their
buckets side by side and need no exchange. Store pre-aggregated rows (``item_counts`` of one day
each): a key then has one row per append, so that a hot key makes no large bucket. The number of
buckets is a property of the table: choose it for the table's final size.

**Sorted catalogue.** ``write_catalogue`` orders cleaned listings by stars, guests and id over all
files, so that a row group covers a narrow range of stars and ``stars >= x`` skips the others by
their statistics. ``catalogue_bounds`` reads counts and ranges from the files' footers alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import require_columns

CATALOGUE_ORDER = ("stars", "guests", "listing_id")


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int,
                   mode: str = "error") -> DataFrame:
    """Write ``df`` as the bucketed table ``table`` with files under ``path`` (shared), sorted by the
    keys, and return the table. ``mode="append"`` adds rows to a table of the same layout; its files
    stay valid buckets. The rows are dealt by the same hash as the buckets, so that a write leaves
    one file a bucket. NULL keys have a bucket of their own hash like any value; an empty frame makes
    an empty table."""
    require_columns(df, *keys)
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_catalogue(listings: DataFrame, path: str, files: int | None = None, group_bytes: int = 16 << 20) -> None:
    """Write cleaned listings sorted by stars, guests and id, in ``files`` ranges (default: the
    session's shuffle partitions) with row groups of about ``group_bytes``. The id is part of the
    range key, so that one frequent rating is spread over files; rows equal in all three share one."""
    require_columns(listings, *CATALOGUE_ORDER)
    n = files or int(listings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = listings.repartitionByRange(n, *CATALOGUE_ORDER).sortWithinPartitions(*CATALOGUE_ORDER)
    ranged.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def catalogue_bounds(spark: SparkSession, path: str) -> DataFrame:
    """One row: total_listings, min_stars, max_stars, min_guests, max_guests of a written catalogue
    (zero and NULLs if it is empty). Counts, minima and maxima are answered by the Parquet footers:
    the plan has pushed aggregates and reads no row group. This needs Spark's own file source of the
    second kind, which a session of its own (same context, same executors) turns on, so that the
    caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = own.read.parquet(path).agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.min("stars").alias("min_stars"),
        F.max("stars").alias("max_stars"),
        F.min("guests").alias("min_guests"),
        F.max("guests").alias("max_guests"),
    )
    # Files without a row group leave a pushed count NULL, which Spark takes for impossible and would
    # not replace if asked plainly.
    total = F.nullif(F.col("total_listings"), F.lit(-1).cast("long"))
    return found.withColumn("total_listings", F.coalesce(total, F.lit(0).cast("long")))
