"""Cutting of lineage into the configured folder, and global numbering."""

import os

import pytest

from placerank.session import materialize


def test_materialize_checkpoints_into_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    out = materialize(df)
    assert out.count() == 100
    written = [os.path.join(d, f) for d, _, files in os.walk(folder.replace("file:", "")) for f in files]
    assert written, "no checkpoint files under spark.checkpoint.dir"


def test_ordinal_equals_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from placerank.operators.ordering import ordinal

    df = spark.range(500).selectExpr("id", "(id * 7919) % 37 AS freq", "concat('k', id % 101) AS label")
    order = [F.col("freq").desc(), F.col("label").asc(), F.col("id").asc()]
    ours = {r.id: r.pos for r in ordinal(df, order, "pos", partitions=7).collect()}
    ref = {r.id: r.pos for r in df.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1).collect()}
    assert ours == ref


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ordinal_numbers_a_large_sampled_input(spark, reuse):
    """Large enough for the range partitioner to sample; with and without exchange reuse."""
    from pyspark.sql import functions as F

    from placerank.operators.ordering import ordinal

    n = 400_000
    df = spark.range(0, n, 1, 8).selectExpr("(id * 7919) % 400000 AS k", "concat('payload ', id) AS extra")
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        out = ordinal(df, [F.col("k").asc()], "pos")
        row = out.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos"), F.count_if(F.col("pos") != F.col("k"))).first()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert tuple(row) == (n, 0, n - 1, 0)
