"""Executed-plan shape: one scan per input, column pruning, no Cartesian product, bounded
broadcasts. Plans are read after execution, when AQE has made its runtime choices."""

import re

import pytest

from placerank.plans.catalog import QUERIES
from placerank.plans.inspect import count_nodes, executed_plan

from .conftest import SF_SMALL


def _scans(plan, table):
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan))


@pytest.mark.parametrize("name", ["keyword_ranking", "popularity_score", "tfidf_terms", "group_shares"])
def test_documents_scanned_once_per_text_pass(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_SMALL))
    # tfidf_terms also reads the item column alone for the document count (no text).
    expected = 2 if name == "tfidf_terms" else 1
    assert _scans(plan, "documents") == expected, plan


def test_popularity_on_sales_scans_each_table_once(spark):
    plan = executed_plan(QUERIES["popularity_score_sales"](spark, SF_SMALL))
    assert _scans(plan, "lineitem") == 1 and _scans(plan, "part") == 1, plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, name):
    if name in ("cluster_items", "tfidf_vectors", "listing_features"):
        pytest.skip("MLlib fit queries run several jobs")
    plan = executed_plan(QUERIES[name](spark, SF_SMALL))
    assert count_nodes(plan, "CartesianProduct") == 0
    # Every nested-loop join is a cross join with a broadcast one-row statistics side.
    for line in plan.splitlines():
        if "BroadcastNestedLoopJoin" in line:
            assert "BuildRight, Cross" in line, line


def test_top_items_reads_one_column(spark):
    plan = executed_plan(QUERIES["top_items"](spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*documents\.parquet", plan)
    assert scans and all(re.fullmatch(r"source#\d+L?", s) for s in scans), scans


def test_top_k_is_take_ordered(spark):
    plan = executed_plan(QUERIES["top_items"](spark, SF_SMALL))
    assert count_nodes(plan, "TakeOrderedAndProject") == 1


def test_per_group_top_n_uses_window_group_limit(spark):
    plan = executed_plan(QUERIES["top_tfidf_terms"](spark, SF_SMALL))
    assert count_nodes(plan, "WindowGroupLimit") >= 1


def test_typed_listings_push_predicates_into_the_scan(spark, tmp_path):
    """Cleaned listings written as parquet: the hybrid filters reach the row groups."""
    from placerank import operators as op
    from placerank.sources import bindings, write_table
    from placerank.schema import LISTINGS

    path = str(tmp_path / "listings")
    write_table(op.clean_listings(bindings.listings_raw(spark, SF_SMALL)), path)
    typed = spark.read.schema(LISTINGS).parquet(path)
    plan = executed_plan(op.hybrid_recommendations(typed, "Any", 2, 4.0, 10))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert pushed and all("GreaterThanOrEqual(stars,4.0)" in p and "GreaterThanOrEqual(guests,2)" in p
                          for p in pushed), pushed


@pytest.mark.parametrize("name", ["top_popular", "browse_popular", "top_popular_50"])
def test_consumers_do_not_pay_for_the_popularity_order(spark, name):
    plan = executed_plan(QUERIES[name](spark, SF_SMALL))
    assert "rangepartitioning" not in plan
    assert count_nodes(plan, "TakeOrderedAndProject") == 1


def test_evaluating_a_hybrid_list_scans_the_catalogue_twice(spark):
    """Once for the star range and the catalogue's size, once for the candidates."""
    plan = executed_plan(QUERIES["evaluate_hybrid"](spark, SF_SMALL))
    assert _scans(plan, "part") <= 2, plan


def test_item_join_reads_the_text_once(spark):
    plan = executed_plan(QUERIES["keyword_ranking_item_join"](spark, SF_SMALL))
    assert _scans(plan, "documents") <= 2, plan
    texts = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*documents\.parquet", plan)
    assert sum("text" in columns for columns in texts) == 1, plan
