"""Invariants on the shared test tables (sf0.001), and brute-force cross-checks of the
operators that have no SQL oracle."""

import pytest
from pyspark.ml.feature import CountVectorizer, IDF
from pyspark.sql import functions as F

from placerank import operators as op
from placerank.functions import english_stop_words
from placerank.sources import bindings

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def posts(spark):
    return bindings.posts(spark, SF_SMALL)


@pytest.fixture(scope="module")
def sales(spark):
    return bindings.sales(spark, SF_SMALL)


def test_group_counts_sum_to_rows(posts):
    total = op.group_counts(posts).agg(F.sum("review_count")).collect()[0][0]
    assert total == posts.count()


def test_popularity_bounds_and_ranks(sales):
    pop = op.popularity_score(sales)
    s = pop.agg(F.min("popularity_score"), F.max("popularity_score"), F.count("*")).collect()[0]
    assert (s[0], s[1]) == (0.0, 100.0)
    first = pop.groupBy("grp").agg(F.min("group_rank").alias("r")).where("r <> 1").count()
    assert first == 0
    assert s[2] == sales.select("item", "grp").distinct().count()


def test_kmeans_clusters_are_intervals(sales):
    k = 4
    clustered = op.cluster_items(op.popularity_score(sales), k=k).cache()
    assert clustered.count() == sales.select("item", "grp").distinct().count()
    spans = sorted(
        (r["lo"], r["hi"])
        for r in clustered.groupBy("prediction").agg(F.min("review_count").alias("lo"),
                                                     F.max("review_count").alias("hi")).collect()
    )
    assert 1 <= len(spans) <= k
    for (lo1, hi1), (lo2, hi2) in zip(spans, spans[1:]):
        assert hi1 < lo2, spans  # inputs are one-dimensional: clusters do not interleave
    labels = {r.cluster_label for r in clustered.select("cluster_label").distinct().collect()}
    assert any(lbl.endswith("Hidden Gem") for lbl in labels)


def test_kmeans_is_repeatable(sales):
    pop = op.popularity_score(sales)
    a = sorted(op.cluster_items(pop, k=3).select("item", "grp", "prediction").collect())
    b = sorted(op.cluster_items(pop, k=3).select("item", "grp", "prediction").collect())
    assert a == b


def test_tfidf_terms_equal_mllib(spark, posts):
    """Exact TF-IDF by term against MLlib CountVectorizer + IDF on concatenated item
    documents (the brute-force form), empty tokens excluded on both sides."""
    ours = {(r.item, r.term): r.tfidf for r in op.tfidf_terms(posts).collect()}
    stop = set(english_stop_words())
    docs = posts.groupBy("item").agg(F.flatten(F.collect_list(F.split(F.lower("text"), r"\s"))).alias("w"))
    docs = docs.withColumn("w", F.filter("w", lambda x: (x != "") & ~x.isin(*stop)))
    cv = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=1 << 24, minDF=1.0).fit(docs)
    tfidf = IDF(inputCol="tf", outputCol="x", minDocFreq=0).fit(cv.transform(docs)).transform(cv.transform(docs))
    vocab = cv.vocabulary
    theirs = {}
    for r in tfidf.select("item", "x").collect():
        for i, v in zip(r.x.indices, r.x.values):
            theirs[(r.item, vocab[i])] = v
    assert set(ours) == set(theirs)
    bad = [k for k in ours if abs(ours[k] - theirs[k]) > 1e-5]
    assert not bad, bad[:5]


def test_tfidf_vectors_shape(posts):
    vecs = op.tfidf_vectors(posts, num_features=64).collect()
    assert len(vecs) == posts.select("item").distinct().count()
    assert all(len(r.tfidf) == 64 for r in vecs)
    terms = op.tfidf_terms(posts).groupBy("item").agg(F.sum("tf").alias("n")).collect()
    assert {r.item: r.n for r in terms} == {r.item: r.n_terms for r in vecs}


def test_top_tfidf_terms_at_most_n_per_item(posts):
    top = op.top_tfidf_terms(op.tfidf_terms(posts), 3)
    assert top.groupBy("item").count().where("count > 3").count() == 0


def test_tfidf_vectors_equal_concatenated_pipeline(posts):
    """Per-post hashed vectors summed per item equal the MLlib pipeline run on each item's
    concatenated tokens (empty tokens dropped on both sides)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, StopWordsRemover

    ours = {r.item: r.tfidf for r in op.tfidf_vectors(posts, num_features=1000).collect()}
    stop = list(english_stop_words()) + [""]
    docs = posts.groupBy("item").agg(
        F.flatten(F.collect_list(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s"))).alias("words")
    )
    model = Pipeline(stages=[
        StopWordsRemover(inputCol="words", outputCol="terms", stopWords=stop),
        HashingTF(inputCol="terms", outputCol="tf", numFeatures=1000),
        IDF(inputCol="tf", outputCol="x", minDocFreq=0),
    ]).fit(docs)
    theirs = {r.item: r.x.toArray() for r in model.transform(docs).select("item", "x").collect()}
    assert set(ours) == set(theirs)
    for item, vec in ours.items():
        assert all(abs(a - b) <= 1e-9 * max(1.0, abs(b)) for a, b in zip(vec, theirs[item])), item
