"""Hand-worked expectations on the five-post fixture (FIXTURES.md §3.1)."""

import pytest
from pyspark.sql import functions as F

from placerank import operators as op
from placerank.schema import POSTS

from .conftest import rows


def test_top_items(posts):
    assert rows(op.top_items(posts, 15), "item", "review_count") == [("A", 3), ("B", 1), ("C", 1)]


def test_top_items_limit_breaks_ties_on_item(posts):
    assert rows(op.top_items(posts, 2), "item", "review_count") == [("A", 3), ("B", 1)]


def test_group_counts_and_shares(posts):
    assert rows(op.group_counts(posts), "grp", "review_count") == [("X", 3), ("Y", 2)]
    shares = rows(op.group_shares(posts), "grp", "share_pct")
    assert shares == [("X", 60.0), ("Y", 40.0)]


def test_period_trend_orders_labels_as_text(posts):
    assert rows(op.period_trend(posts), "period", "review_count") == [
        (None, 1), ("2 years ago", 3), ("a year ago", 1)
    ]


def test_distinct_items_per_group(posts):
    assert rows(op.distinct_items_per_group(posts), "grp", "unique_items") == [("X", 2), ("Y", 2)]


def test_posts_overview_counts_null_as_a_value(posts):
    r = op.posts_overview(posts).collect()[0]
    assert (r.total_posts, r.total_items, r.total_groups, r.total_periods) == (5, 3, 2, 3)


def test_group_options(posts):
    assert [r.grp for r in op.group_options(posts).collect()] == ["All Districts", "X", "Y"]


def test_popularity_score(posts):
    got = rows(op.popularity_score(posts), "item", "grp", "review_count", "popularity_score", "group_rank")
    assert got == [
        ("A", "X", 2, 100.0, 1),
        ("A", "Y", 1, 0.0, 1),
        ("B", "X", 1, 0.0, 2),
        ("C", "Y", 1, 0.0, 1),
    ]


def test_popularity_all_counts_equal_gives_null(spark):
    df = spark.createDataFrame([(1, "A", "X", None, "t"), (2, "B", "X", None, "t")], schema=POSTS)
    got = rows(op.popularity_score(df), "item", "popularity_score", "group_rank")
    assert got == [("A", None, 1), ("B", None, 1)]


def test_rank_within_equals_window_rank(spark):
    from pyspark.sql import Window

    data = [(g, float(s) if s is not None else None) for g, s in
            [("a", 3), ("a", 3), ("a", 1), ("a", None), ("b", 5), ("b", 2), ("b", 5), (None, 1), (None, 1)]]
    df = spark.createDataFrame(data, "g string, s double")
    ours = op.rank_within(df, "g", "s", "r")
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.col("s").desc_nulls_last())))
    key = lambda t: (t[0] is None, t[0] or "", t[1] is None, t[1] or 0.0, t[2])
    assert sorted(rows(ours, "g", "s", "r"), key=key) == sorted(rows(ref, "g", "s", "r"), key=key)


def test_top_words(posts):
    assert rows(op.top_words(posts, 20), "word", "frequency") == [("beach", 3), ("temple", 1)]


def test_word_frequency_map(posts):
    r = op.word_frequency_map(op.top_words(posts, 100)).collect()[0]
    assert dict(r.word_freq) == {"beach": 3, "temple": 1}


def test_keyword_ranking(posts):
    got = rows(op.keyword_ranking(posts, ["beach"]), "item", "grp", "keyword_freq", "relevance_score", "final_score")
    assert got == [("A", "X", 2.0, 100.0, 100.0), ("B", "X", 1.0, 100.0, 80.0)]


def test_keyword_ranking_item_only_join_repeats_rows(posts):
    got = rows(op.keyword_ranking(posts, ["beach"], join_keys=("item",)), "item", "grp", "final_score")
    assert sorted(got) == sorted([("A", "X", 100.0), ("A", "X", 80.0), ("B", "X", 80.0)])


@pytest.mark.parametrize("kws", [[], ["  "], ["zzz"]])
def test_keyword_ranking_empty(posts, kws):
    out = op.keyword_ranking(posts, kws)
    assert out.columns == ["item", "grp", "review_count", "keyword_freq", "relevance_score", "final_score"]
    assert out.count() == 0


def test_keyword_is_literal_not_regex(spark):
    df = spark.createDataFrame([(1, "A", "X", None, "a.c abc a.c"), (2, "B", "X", None, "abc")], schema=POSTS)
    got = rows(op.keyword_ranking(df, ["a.c"]), "item", "keyword_freq")
    assert got == [("A", 2.0)]


def test_keyword_group_filter_after_and_before(posts):
    after = op.keyword_ranking(posts, ["beach"], n=1, grp="X")
    assert rows(after, "item") == [("A",)]
    before = op.keyword_ranking(posts, ["beach", "temple"], n=1, grp="Y", group_filter_stage="before")
    assert before.count() == 0


def test_ranking_summaries(posts):
    res = op.keyword_ranking(posts, ["beach"])
    s = op.ranking_summary(res).collect()[0]
    assert (s.result_count, s.avg_score, s.groups_covered) == (2, 100.0, 1)
    assert rows(op.score_by_group(res), "grp", "total_score") == [("X", 180.0)]
    assert rows(op.top_recommendation(res), "item", "grp", "score", "review_count") == [("A", "X", 100.0, 2)]
    shown = op.display_columns(res, "keyword")
    assert shown.columns[:3] == ["Destination", "District", "Total Reviews"]


def test_browse_and_average(posts):
    pop = op.popularity_score(posts)
    assert rows(op.browse_popular(pop, None, 10.0, 10), "item", "grp") == [("A", "X")]
    assert rows(op.browse_popular(pop, "Y", 0.0, 10), "item") == [("A",), ("C",)]
    assert rows(op.avg_popularity_by_group(pop), "grp", "avg_popularity") == [("X", 50.0), ("Y", 0.0)]
    assert rows(op.top_popular(pop, 1), "item") == [("A",)]


def test_cleaning_comparison(spark, posts):
    raw = spark.createDataFrame(
        [(1, "A", "X", "p", "t"), (2, "", None, "p", ""), (3, None, "X", None, "t"), (4, "A", "X", "p", "t")],
        schema=POSTS,
    )
    got = rows(op.compare_profiles(raw, posts), "metric", "raw_value", "clean_value")
    assert got == [
        ("Total Rows", 4, 5),
        ("Null Values", 5, 2),
        ("Unique Destinations", 3, 3),
        ("Unique Districts", 2, 2),
    ]


def test_label_clusters_rules(spark):
    df = spark.createDataFrame(
        [("a", "g", 1, 10.0, 0), ("b", "g", 1, 90.0, 1), ("c", "g", 1, 50.0, 2), ("d", "g", 1, 90.0, 3)],
        "item string, grp string, review_count long, popularity_score double, prediction int",
    )
    got = dict(rows(op.label_clusters(df), "item", "cluster_label"))
    assert got["a"].endswith("Hidden Gem")
    assert got["b"].endswith("Popular Hotspot")  # equal means: lowest cluster id wins
    assert got["c"].endswith("Regular Destination")
    assert got["d"].endswith("Regular Destination")


def test_label_clusters_single_cluster_is_hidden_gem(spark):
    df = spark.createDataFrame([("a", "g", 1, 10.0, 0)],
                               "item string, grp string, review_count long, popularity_score double, prediction int")
    assert rows(op.label_clusters(df), "cluster_label")[0][0].endswith("Hidden Gem")


def test_approximate_distinct_counts(spark):
    from placerank.sources import bindings

    from .conftest import SF_SMALL

    posts = bindings.posts(spark, SF_SMALL)
    exact = op.posts_overview(posts).collect()[0]
    approx = op.posts_overview(posts, approx_rsd=0.02).collect()[0]
    for field in ("total_items", "total_groups", "total_periods"):
        assert abs(approx[field] - exact[field]) <= max(1, 0.05 * exact[field])
    e = dict(rows(op.distinct_items_per_group(posts), "grp", "unique_items"))
    a = dict(rows(op.distinct_items_per_group(posts, approx_rsd=0.02), "grp", "unique_items"))
    assert set(a) == set(e) and all(abs(a[g] - e[g]) <= max(1, 0.05 * e[g]) for g in e)


def test_keyword_ranking_min_final_score(posts):
    assert rows(op.keyword_ranking(posts, ["beach"], min_final_score=90.0), "item", "final_score") == [("A", 100.0)]
    assert op.keyword_ranking(posts, ["beach"], min_final_score=0.0).count() == 2


def test_keyword_regex_mode_reproduces_pattern_counting(spark):
    df = spark.createDataFrame([(1, "A", "X", None, "a.c abc"), (2, "B", "X", None, "xyz")], schema=POSTS)
    literal = dict(rows(op.keyword_ranking(df, ["a.c"]), "item", "keyword_freq"))
    regex = dict(rows(op.keyword_ranking(df, ["a.c"], keyword_match="regex"), "item", "keyword_freq"))
    assert literal == {"A": 1.0} and regex == {"A": 2.0}
    # Matches shorter than the pattern give fractions, as in the reference: "a+" on "aaa" removes 3 chars / 2.
    df2 = spark.createDataFrame([(1, "A", "X", None, "aaa")], schema=POSTS)
    assert rows(op.keyword_ranking(df2, ["a+"], keyword_match="regex"), "keyword_freq") == [(1.5,)]
