"""Bucketed counts, the sorted catalogue and heavy-hitter words: results and executed plans."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from placerank import operators as op
from placerank.plans.inspect import count_nodes, executed_plan
from placerank.sources import bindings, catalogue_bounds, write_bucketed, write_catalogue

from .conftest import SF_SMALL, rows


def _table():
    return f"t_{uuid.uuid4().hex}"


def _below_aggregate(plan):
    """The plan's lines from the first aggregate down to its scan (printed top-down)."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "HashAggregate" in line)
    return "\n".join(lines[at:])


def test_sums_over_buckets_need_no_exchange(spark, tmp_path):
    posts = bindings.posts_raw(spark, SF_SMALL)
    half = F.col("post_id") % 2 == 0
    table, path = _table(), str(tmp_path / "counts")
    write_bucketed(op.item_counts(posts.where(half)), table, path, ("item", "grp"), 8)
    stored = write_bucketed(op.item_counts(posts.where(~half)), table, path, ("item", "grp"), 8, mode="append")
    summed = op.summed_counts(stored)
    assert count_nodes(executed_plan(summed), "Exchange") == 0
    whole = op.item_counts(posts)
    assert summed.exceptAll(whole).isEmpty() and whole.exceptAll(summed).isEmpty()
    got, want = op.popularity_of_counts(summed), op.popularity_score(posts)
    assert got.collect() == want.collect()


def test_tables_of_the_same_buckets_join_without_an_exchange(spark, tmp_path):
    counts = op.item_counts(bindings.posts_raw(spark, SF_SMALL))
    a = write_bucketed(counts, _table(), str(tmp_path / "a"), ("item", "grp"), 8)
    b = write_bucketed(counts, _table(), str(tmp_path / "b"), ("item", "grp"), 8)
    b = b.withColumnRenamed("review_count", "earlier")
    joined = op.summed_counts(a).join(b.hint("merge"), ["item", "grp"])
    plan = executed_plan(joined)
    assert count_nodes(plan, "SortMergeJoin") == 1 and count_nodes(plan, "Exchange") == 0, plan
    assert joined.where("review_count <> earlier").isEmpty()


def test_bucketed_table_of_nothing_and_of_nulls(spark, tmp_path):
    none = spark.createDataFrame([], "item string, grp string, review_count bigint")
    assert op.summed_counts(write_bucketed(none, _table(), str(tmp_path / "n"), ("item", "grp"), 4)).count() == 0
    data = [(None, None, 2), (None, "x", 1), (None, None, 3), ("a", None, 1)]
    some = spark.createDataFrame(data, none.schema)
    got = op.summed_counts(write_bucketed(some, _table(), str(tmp_path / "s"), ("item", "grp"), 4))
    assert sorted(map(str, rows(got, "item", "grp", "review_count"))) == sorted(
        map(str, [(None, None, 5), (None, "x", 1), ("a", None, 1)])
    )


def test_bounds_come_from_footers(spark, tmp_path):
    listings = op.clean_listings(bindings.listings_raw(spark, SF_SMALL))
    path = str(tmp_path / "catalogue")
    write_catalogue(listings, path, files=8)
    bounds = catalogue_bounds(spark, path)
    plan = executed_plan(bounds)
    pushed = re.search(r"PushedAggregation: \[([^\]]*)\]", plan)
    assert pushed and "COUNT(*)" in pushed.group(1) and "MAX(stars)" in pushed.group(1), plan
    want = listings.agg(F.count(F.lit(1)), F.min("stars"), F.max("stars"), F.min("guests"), F.max("guests"))
    assert bounds.collect()[0][:] == want.collect()[0][:]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was


def test_predicates_on_stars_skip_row_groups(spark, tmp_path):
    listings = spark.range(40_000).select(
        F.col("id").alias("listing_id"), F.lit("n").alias("name"), F.lit("t").alias("room_type"),
        (F.hash("id") % 5).cast("int").alias("guests"), (F.pmod(F.hash(F.col("id") + 1), F.lit(500)) / 100).cast("float").alias("stars"),
    )
    path = str(tmp_path / "sorted")
    write_catalogue(listings, path, files=16)
    high = spark.read.parquet(path).where("stars >= 4.5")
    assert high.count() == listings.where("stars >= 4.5").count()
    qe = high._jdf.queryExecution()
    qe.toRdd().count()
    scan = qe.executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numOutputRows").value()
    assert 0 < high.count() <= read <= 40_000 // 4


def test_catalogue_of_nothing(spark, tmp_path, listings_raw):
    none = op.clean_listings(listings_raw).limit(0)
    write_catalogue(none, str(tmp_path / "none"), files=2)
    assert catalogue_bounds(spark, str(tmp_path / "none")).collect()[0][:] == (0, None, None, None, None)


def _scans(plan):
    return len(re.findall(r"FileScan parquet [^\n]*documents\.parquet", plan))


def test_heavy_words_equal_the_full_count_and_do_not_run_it(spark):
    posts = bindings.posts(spark, SF_SMALL)
    heavy = op.heavy_top_words(posts, 20)
    assert heavy.collect() == op.top_words(posts, 20).collect()
    assert _scans(executed_plan(heavy)) == 0  # both passes are done; the full count was dropped


@pytest.mark.parametrize("slots", [128, 1024])
def test_flat_words_take_the_exact_way(spark, slots):
    """Every word equally frequent: no candidate is above the bound."""
    posts = spark.range(4000).select(F.lit("i").alias("item"), F.concat(F.lit("word"), F.col("id")).alias("text"))
    heavy = op.heavy_top_words(posts, 20, slots)
    assert heavy.collect() == op.top_words(posts, 20).collect()
    assert heavy.count() == 20


def test_heavy_words_of_odd_texts(spark):
    long = "x" * 5000
    data = [(None,), ("",), ("    ",), ("with this from have",), ("Beach beach sun",), (f"{long} {long} {long} beach",), ("ÄÖÜß äöüß",)]
    posts = spark.createDataFrame(data, "text string").withColumn("word", F.lit("own")).withColumn("_word", F.lit(1))
    for n in (1, 3, 20):
        assert op.heavy_top_words(posts, n).collect() == op.top_words(posts, n).collect()
    assert op.heavy_top_words(posts.limit(0)).count() == 0
    with pytest.raises(ValueError):
        op.heavy_top_words(posts, 20, slots=100)
