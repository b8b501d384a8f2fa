"""A third of all posts on one item: results stay exact (Spark against the same oracle SQL
run by DuckDB on the same skewed binding), and aggregates stay partial before shuffles."""

import math

import duckdb
import pytest

from placerank.plans.catalog import KEYWORDS, RANKING_N, TOP_ITEMS_N, TOP_TERMS_N
from placerank.plans.inspect import executed_plan
from placerank.plans.oracle import oracle_queries
from placerank import operators as op
from placerank.sources import bindings

from .conftest import SF_SMALL

HOT = "CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE source END AS item"
SKEWED = [HOT if e == "source AS item" else e for e in bindings.POSTS_EXPRS]


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr(*SKEWED)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    for t in ("lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _oracle(con, name):
    plain = "WITH posts AS (SELECT " + ", ".join(bindings.POSTS_EXPRS) + " FROM documents)"
    hot = "WITH posts AS (SELECT " + ", ".join(SKEWED) + " FROM documents)"
    sql = oracle_queries()[name]
    assert plain in sql
    return con.sql(sql.replace(plain, hot, 1))


def _same(df, rel):
    key = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    norm = lambda r: tuple("NaN" if isinstance(x, float) and math.isnan(x) else x for x in r)
    order = [rel.columns.index(c) for c in df.columns]
    theirs = sorted((norm(tuple(r[i] for i in order)) for r in rel.fetchall()), key=key)
    ours = sorted((norm(tuple(r)) for r in df.collect()), key=key)
    return ours == theirs


QUERIES = {
    "top_items": lambda p: op.top_items(p, TOP_ITEMS_N),
    "distinct_items_per_group": op.distinct_items_per_group,
    "popularity_score": op.popularity_score,
    "keyword_ranking": lambda p: op.keyword_ranking(p, KEYWORDS, n=RANKING_N),
    "tfidf_terms": op.tfidf_terms,
    "top_tfidf_terms": lambda p: op.top_tfidf_terms(op.tfidf_terms(p), TOP_TERMS_N),
}


def test_binding_is_skewed(skewed):
    hot = skewed.where("item = 'hot'").count()
    assert abs(hot / skewed.count() - 1 / 3) < 0.01


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_skewed_results_match_oracle(skewed, con, name):
    assert _same(QUERIES[name](skewed), _oracle(con, name))


def test_hot_item_is_reduced_before_the_shuffle(skewed):
    plan = executed_plan(op.keyword_ranking(skewed, KEYWORDS))
    exchange_at = plan.index("Exchange hashpartitioning(item")
    assert "partial_count" in plan[exchange_at:], "no partial aggregate under the (item, grp) exchange"


def test_a_term_of_every_item_is_split_in_the_tfidf_join(spark):
    """One term in all items: its rows meet the per-term table in several tasks."""
    posts = spark.range(0, 300_000, 1, 8).selectExpr(
        "concat('item', id) AS item", "concat('everywhere word', id % 1000) AS text"
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        plan = executed_plan(op.tfidf_terms(posts))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan, plan


def test_clusters_do_not_follow_the_session_settings(spark):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    popularity = op.popularity_score(bindings.sales(spark, SF_SMALL))
    try:
        for n in ("4", "8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = op.cluster_items(popularity, 4).collect()
            found.append(sorted((r["item"], r["grp"], r["prediction"], r["cluster_label"]) for r in rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
