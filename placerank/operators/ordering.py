"""Consecutive positions in a global order without a single-partition window.

``row_number()`` over an unpartitioned window moves every row to one task. Here the rows
are range-partitioned on the order (partition i holds only keys before partition i+1's) and
numbered inside each partition. The numbered rows are written once (a checkpoint), since
the bounds of a range partitioning come from a sample and a second evaluation may choose
others; from the written rows come the partition sizes, which are prefix-summed (one row
per partition) and added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def ordinal(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` = 0, 1, 2, ... following ``order`` (which must be total). Runs a
    job: the rows are checkpointed with their partition and their number in it."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    local = materialize(
        ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    )
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_opart"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    # One row per partition: a broadcast bounded by ``partitions``.
    joined = local.join(F.broadcast(offsets), local["_part"] == offsets["_opart"], "inner")
    return joined.withColumn(name, F.col("_offset") + F.col("_local") - F.lit(1)).drop(
        "_part", "_local", "_opart", "_offset"
    )
