"""Sparse TF-IDF, optimal clusters and joined feature vectors against MLlib and brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from placerank import operators as op
from placerank.sources import bindings

from .conftest import SF_SMALL


def test_sparse_vectors_equal_mllib(spark):
    posts = bindings.posts(spark, SF_SMALL)
    dense = {r["item"]: r for r in op.tfidf_vectors(posts).collect()}
    sparse = op.tfidf_sparse_vectors(posts).collect()
    assert {r["item"] for r in sparse} == set(dense)
    for r in sparse:
        want = dense[r["item"]]
        assert r["n_terms"] == want["n_terms"] and r["indices"] == sorted(r["indices"])
        filled = dict(zip(r["indices"], r["values"], strict=True))
        for i, x in enumerate(want["tfidf"]):
            assert abs(filled.get(i, 0.0) - x) < 1e-5


def test_items_without_terms_and_no_items(spark, posts):
    rows = {r["item"]: r for r in op.tfidf_sparse_vectors(posts).collect()}
    assert rows["C"]["indices"] == [] and rows["C"]["n_terms"] == 0
    assert op.tfidf_sparse_vectors(posts.where(F.lit(False))).count() == 0
    with pytest.raises(ValueError):
        op.tfidf_buckets(posts, buckets="other")


def _cost(values, weights):
    n = sum(weights)
    return sum(w * x * x for x, w in zip(values, weights, strict=True)) - sum(w * x for x, w in zip(values, weights, strict=True)) ** 2 / n


@pytest.mark.parametrize("seed", range(25))
def test_cuts_are_the_best_ones(seed):
    r = random.Random(seed)
    values = sorted(r.sample(range(200), r.randint(1, 12)))
    weights, k = [r.randint(1, 9) for _ in values], r.randint(1, 5)
    got = op.best_cuts(values, weights, k)
    n = len(values)

    def total(cuts):
        ends = [0, *cuts, n]
        return sum(_cost(values[a:b], weights[a:b]) for a, b in zip(ends, ends[1:], strict=False))

    best = min(total(c) for c in itertools.combinations(range(1, n), min(k, n) - 1))
    assert got == sorted(set(got)) and total(got) == pytest.approx(best, abs=1e-6)


def test_kmeans_is_near_the_optimum(spark):
    popularity = op.popularity_score(bindings.sales(spark, SF_SMALL))
    total = lambda df: op.cluster_cost(df).agg(F.sum("cost")).first()[0]
    best, found = total(op.optimal_clusters(popularity, 4)), total(op.cluster_items(popularity, 4))
    assert 0 < best <= found + 1e-6 and found <= 2 * best


def test_clusters_of_odd_tables(spark):
    schema = "item string, grp string, review_count bigint, popularity_score double"
    rows = [("a", "x", 5, None), ("b", "x", 5, None), ("c", None, None, None)]
    got = {r["item"]: r["prediction"] for r in op.optimal_clusters(spark.createDataFrame(rows, schema), 4).collect()}
    assert got == {"a": 0, "b": 0, "c": None}
    assert op.optimal_clusters(spark.createDataFrame([], schema), 4).count() == 0


def test_feature_vectors_equal_mllib(spark):
    listings = op.clean_listings(bindings.listings_raw(spark, SF_SMALL))
    want = {r["listing_id"]: r for r in op.listing_feature_arrays(listings).collect()}
    got = op.listing_feature_vectors(listings).collect()
    assert len(got) == len(want) > 0
    for r in got:
        w = want[r["listing_id"]]
        assert r["room_type_index"] == w["room_type_index"] and r["feature_vector"] == pytest.approx(w["feature_vector"])
        assert r["normalised_features"] == pytest.approx(w["normalised_features"])


def test_feature_vectors_of_many_room_types(spark):
    rows = spark.range(20_000).selectExpr(
        "id AS listing_id", "'n' AS name", "concat('type ', id % 10000) AS room_type", "cast(2 AS int) AS guests", "cast(4 AS float) AS stars")
    got = op.listing_feature_vectors(rows)
    assert got.agg(F.count_distinct("room_type_index")).first()[0] == 10_000
    assert got.where("listing_id IN (0, 10000)").select("room_type_index", "feature_vector").distinct().collect()[0]["feature_vector"][2] == 0.0
