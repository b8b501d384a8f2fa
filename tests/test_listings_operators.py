"""Hand-worked expectations on the ten-listing fixture (FIXTURES.md §3.2)."""

import pytest

from placerank import operators as op

from .conftest import rows


@pytest.fixture(scope="module")
def listings(listings_raw):
    return op.clean_listings(listings_raw).cache()


def test_clean_listings(listings):
    got = rows(listings.orderBy("listing_id"), "listing_id", "guests", "stars")
    assert [(i, g, round(s, 4)) for i, g, s in got] == [(1, 4, 4.8), (2, 2, 5.0), (3, 16, 4.5), (7, 2, 3.9)]
    assert [f.dataType.simpleString() for f in listings.schema.fields] == ["bigint", "string", "string", "int", "float"]


def test_listings_overview(listings):
    r = op.listings_overview(listings).collect()[0]
    assert (r.total_listings, r.unique_room_types, r.avg_stars, r.max_guests) == (4, 3, 4.55, 16)


def test_room_types(listings):
    assert [r.room_type for r in op.room_types(listings).collect()] == [
        "Any", "Entire villa", "Hotel room", "Private room"
    ]


def test_room_type_ranking(listings):
    got = rows(op.room_type_ranking(listings), "room_type", "avg_stars", "listing_count", "max_stars")
    assert [(t, a, n, round(m, 2)) for t, a, n, m in got] == [
        ("Entire villa", 4.9, 2, 5.0), ("Private room", 4.5, 1, 4.5), ("Hotel room", 3.9, 1, 3.9)
    ]


def test_content_recommendations(listings):
    assert rows(op.content_recommendations(listings, "room", 2), "listing_id") == [(3,), (7,)]
    assert rows(op.content_recommendations(listings, "Any", 3), "listing_id") == [(1,), (3,)]


def test_hybrid_recommendations(listings):
    got = rows(op.hybrid_recommendations(listings, "Any", 2, 4.0), "listing_id", "hybrid_score")
    assert got == [(2, 0.9986), (1, 0.6592), (3, 0.15)]


def test_hybrid_empty_candidates(listings):
    assert op.hybrid_recommendations(listings, "castle", 2).count() == 0


def test_score_breakdown_parts_add_up(listings):
    for r in op.score_breakdown(listings, "Any", 2, 4.0).collect():
        assert round(r.stars_part + r.match_part, 4) == r.hybrid_score


def test_evaluate_hybrid(listings):
    recs = op.hybrid_recommendations(listings, "Any", 2, 4.0)
    r = op.evaluate_recommendations(recs, listings, 2).collect()[0]
    assert (r.precision_at_k, r.total_recommended, r.relevant_count, r.coverage) == (1.0, 3, 3, 75.0)
    assert r.precision_band == "70-100"


def test_evaluate_content(listings):
    recs = op.content_recommendations(listings, "room", 2)
    r = op.evaluate_recommendations(recs, listings, 2).collect()[0]
    assert (r.precision_at_k, r.total_recommended, r.relevant_count, r.coverage) == (0.5, 2, 1, 50.0)
    assert r.precision_band == "40-70"


def test_evaluate_empty_is_zero(listings):
    recs = op.hybrid_recommendations(listings, "castle", 2)
    r = op.evaluate_recommendations(recs, listings, 2).collect()[0]
    assert (r.precision_at_k, r.total_recommended, r.relevant_count, r.coverage) == (0.0, 0, 0, 0.0)


def test_listing_feature_columns(listings):
    got = rows(op.listing_feature_columns(listings).orderBy("listing_id"),
               "listing_id", "guest_bucket", "stars_normalised", "room_type_index")
    assert [(i, b, round(s, 4), x) for i, b, s, x in got] == [
        (1, 3, 0.8182, 0), (2, 2, 1.0, 0), (3, 4, 0.5455, 2), (7, 2, 0.0, 1)
    ]


def test_listing_features_vectors_match_columns(listings):
    vec = {r.listing_id: r for r in op.listing_feature_arrays(listings).collect()}
    cols = {r.listing_id: r for r in op.listing_feature_columns(listings).collect()}
    for lid, r in vec.items():
        c = cols[lid]
        assert r.room_type_index == c.room_type_index
        assert r.feature_vector[1] == c.guest_bucket
        assert abs(r.feature_vector[2] - c.stars_normalised) < 1e-12
        norm = sum(x * x for x in r.normalised_features) ** 0.5
        assert abs(norm - 1.0) < 1e-9 or norm == 0.0


def test_recommendation_summary_and_distribution(listings):
    recs = op.hybrid_recommendations(listings, "Any", 2, 4.0)
    s = op.recommendation_summary(recs).collect()[0]
    assert s.total_recommendations == 3 and s.avg_stars == 4.77 and round(s.top_stars, 2) == 5.0
    assert rows(op.room_type_distribution(recs), "room_type", "listing_count") == [
        ("Entire villa", 2), ("Private room", 1)
    ]


def test_null_room_type_gets_number_of_labels(spark):
    from placerank.schema import LISTINGS

    df = spark.createDataFrame(
        [(1, "a", "Villa", 2, 4.0), (2, "b", "Villa", 2, 5.0), (3, "c", "Room", 1, 3.0), (4, "d", None, 3, 4.5)],
        schema=LISTINGS,
    )
    got = dict(rows(op.listing_feature_columns(df), "listing_id", "room_type_index"))
    assert got == {1: 0, 2: 0, 3: 1, 4: 2}
    vec = {r.listing_id: r.room_type_index for r in op.listing_feature_arrays(df).collect()}
    assert vec == got


def test_top_recommendation_for_listings(listings):
    from placerank.operators import top_recommendation

    best = top_recommendation(op.hybrid_recommendations(listings, "Any", 2, 4.0)).collect()
    assert [(r.listing_id, r.score) for r in best] == [(2, 0.9986)]
    by_stars = top_recommendation(op.content_recommendations(listings, "room", 2)).collect()
    assert [(r.listing_id, r.score) for r in by_stars] == [(3, 4.5)]
