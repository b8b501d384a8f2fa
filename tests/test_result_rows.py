"""Result rows that a results page shows, and the oracle's parameters as literals (the oracle
takes them from the library, so an error there would cancel out)."""

from placerank import operators as op
from placerank.functions import ENGLISH_STOP_WORDS, FREQUENCY_STOP_WORDS
from placerank.plans import catalog as q
from placerank.schema import LISTINGS
from placerank.sources import bindings


def test_content_top_row_is_the_first_shown(spark):
    rows = [(1, "a", "villa", 2, 4.8), (2, "b", "villa", 6, 4.8), (3, "c", "villa", 9, 4.1)]
    recs = op.content_recommendations(spark.createDataFrame(rows, LISTINGS), "villa", 2)
    assert [r["listing_id"] for r in recs.collect()] == [2, 1, 3]
    assert op.top_recommendation(recs).first()["listing_id"] == 2


def test_room_type_mode_has_a_summary_and_a_top_row(spark):
    rows = [(1, "a", "villa", 2, 4.8), (2, "b", "room", 6, 4.9), (3, "c", None, 9, 4.1)]
    ranked = op.room_type_ranking(spark.createDataFrame(rows, LISTINGS))
    top = op.top_recommendation(ranked).first()
    assert (top["room_type"], top["score"]) == ("room", 4.9)
    assert tuple(op.recommendation_summary(ranked).first()) == (3, None, None, None)


def test_null_groups_are_left_out(spark):
    rows = [(1, "a", None, 2, 4.8), (2, "b", "room", 6, 4.9)]
    recs = spark.createDataFrame(rows, LISTINGS)
    assert [tuple(r) for r in op.room_type_distribution(recs).collect()] == [("room", 1)]
    popularity = spark.createDataFrame([("A", None, 3, 9.0), ("B", "X", 1, 1.0)], "item string, grp string, review_count bigint, popularity_score double")
    assert [tuple(r) for r in op.avg_popularity_by_group(popularity).collect()] == [("X", 1.0)]


def test_evaluation_needs_a_catalogue_or_its_size(spark):
    rows = [(1, "a", "villa", 2, 4.8), (2, "b", "room", 6, 3.9)]
    listings = spark.createDataFrame(rows, LISTINGS)
    sized = op.hybrid_recommendations(listings, "Any", 2, 3.0, keep_size=True)
    plain = op.hybrid_recommendations(listings, "Any", 2, 3.0)
    a = op.evaluate_recommendations(sized, None, 2).first()
    assert a == op.evaluate_recommendations(plain, listings, 2).first()
    assert (a["precision_at_k"], a["coverage"], a["precision_target_pct"]) == (0.5, 100.0, 70.0)


def test_parameters_and_bindings_are_what_the_oracle_assumes():
    assert (q.KEYWORDS, q.RANKING_N, q.TOP_WORDS_N, q.TOP_TERMS_N) == (("und", "pour"), 10, 20, 10)
    assert (q.HYBRID_ARGS, q.CONTENT_ARGS) == (("Any", 2, 4.0, 10), ("small", 2, 10))
    assert FREQUENCY_STOP_WORDS[:5] == ("this", "that", "with", "from", "they") and len(FREQUENCY_STOP_WORDS) == 15
    assert len(ENGLISH_STOP_WORDS) == 181 and {"the", "wouldn't", "cannot"} <= set(ENGLISH_STOP_WORDS)
    assert bindings.POSTS_EXPRS == [
        "doc_id AS post_id", "source AS item", "lang AS grp", "concat(doc_id % 12, ' months ago') AS period", "text",
    ]
