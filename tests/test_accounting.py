"""Rejection counts of the catalogue, stored overview sketches, and the item-only join of a hot item."""

import pytest
from pyspark.sql import functions as F

from placerank import operators as op
from placerank.plans.catalog import QUERIES
from placerank.plans.inspect import executed_plan
from placerank.sources import bindings

from .conftest import SF_SMALL, rows

REJECTED = {"kept": 4, "bad_stars": 3, "bad_guests": 2, "no_guests": 1}


def test_rejections_by_reason(spark, listings_raw):
    assert dict(rows(op.rejection_counts(listings_raw), "reason", "listings")) == REJECTED
    assert dict(rows(op.rejection_counts(listings_raw.where(F.lit(False))), "reason", "listings")) == dict.fromkeys(REJECTED, 0)
    nulls = spark.createDataFrame([(None,) * 5, (1, None, None, None, "4.0"), (2, None, None, "2", None)], listings_raw.schema)
    assert dict(rows(op.rejection_counts(nulls), "reason", "listings")) == {"kept": 0, "bad_stars": 2, "bad_guests": 1, "no_guests": 0}


def test_rejections_are_observed_while_the_rows_are_written(listings_raw, tmp_path):
    cleaned, seen = op.observed_clean_listings(listings_raw)
    path = f"file://{tmp_path}/listings"
    cleaned.write.parquet(path)
    assert seen.get == REJECTED
    kept = listings_raw.sparkSession.read.parquet(path)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, op.clean_listings(listings_raw).collect()))


def test_rejections_take_one_scan(spark):
    plan = executed_plan(QUERIES["listings_rejected"](spark, SF_SMALL))
    assert plan.count("part.parquet") == 1, plan


def test_merged_halves_equal_the_whole(spark):
    posts = bindings.posts_raw(spark, SF_SMALL)
    whole = op.merged_overview(op.overview_sketches(posts)).first()
    halves = [op.overview_sketches(posts.where(F.col("post_id") % 2 == i)) for i in (0, 1)]
    assert op.merged_overview(halves[0].unionByName(halves[1])).first() == whole
    assert tuple(whole) == tuple(op.posts_overview(posts).first())
    assert tuple(op.merged_overview(halves[0].where(F.lit(False))).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("lg_k, most", [(10, 0.13), (12, 0.07)])
def test_error_of_many_values(spark, lg_k, most):
    # Four standard deviations of a sketch of 2 ** lg_k registers.
    posts = spark.range(200_000).selectExpr("id AS post_id", "concat('i', id % 50000) AS item", "IF(id % 9 = 0, NULL, 'g') AS grp",
                                            "concat(id % 30, ' days') AS period", "'' AS text")
    got = op.merged_overview(op.overview_sketches(posts, lg_k=lg_k)).first()
    assert abs(got["total_items"] / 50_000 - 1) < most
    assert (got["total_posts"], got["total_groups"], got["total_periods"]) == (200_000, 2, 30)


def test_sketches_of_two_sizes_merge(spark, posts):
    both = op.overview_sketches(posts, lg_k=10).unionByName(op.overview_sketches(posts, lg_k=12))
    once = op.posts_overview(posts).first()
    assert tuple(op.merged_overview(both).first())[1:] == tuple(once)[1:]


def test_item_join_of_an_item_in_many_groups(spark):
    # One item in 300 groups, another without a name: G popularities for each of G pairs.
    data = [(g, "hot", f"g{g}", None, "sun" if g % 3 == 0 else "rain") for g in range(300)]
    data += [(1000, None, "g1", None, "sun"), (1001, "cold", "g1", None, "sun"), (1002, "cold", "g1", None, "sun")]
    df = spark.createDataFrame(data, bindings_schema()).repartition(4)
    got = op.keyword_ranking(df, ["sun"], n=10**6, join_keys=("item",))
    counts = {(r["item"], r["grp"]): r["n"] for r in got.groupBy("item", "grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {("hot", f"g{g}"): 300 for g in range(0, 300, 3)}
    assert counts == {**want, (None, "g1"): 1, ("cold", "g1"): 1}
    plan = executed_plan(got)
    assert "collect_list" not in plan and "Window" not in plan


def bindings_schema():
    from placerank.schema import POSTS

    return POSTS
