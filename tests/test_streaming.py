"""Streaming counts equal the batch counts over the same input."""

import os
import shutil

from placerank import operators as op
from placerank.sources import bindings
from placerank.streaming import latest_snapshot, read_documents_stream, running_counts, start_counts

from .conftest import SF_SMALL


def test_stream_group_counts_equal_batch(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    shutil.copy(os.path.join(SF_SMALL, "documents.parquet"), src / "part-0.parquet")
    stream = read_documents_stream(spark, str(src), max_files_per_trigger=1)
    q = start_counts(running_counts(stream, ("grp",)), str(tmp_path / "ckpt"), "stream_group_counts",
                     sink="memory")
    q.awaitTermination(120)
    got = {r.grp: r.review_count for r in spark.table("stream_group_counts").collect()}
    want = {r.grp: r.review_count for r in op.group_counts(bindings.posts(spark, SF_SMALL)).collect()}
    assert got == want


def test_stream_counts_to_parquet_snapshot(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    shutil.copy(os.path.join(SF_SMALL, "documents.parquet"), src / "part-0.parquet")
    out = str(tmp_path / "counts")
    stream = read_documents_stream(spark, str(src))
    q = start_counts(running_counts(stream, ("item", "grp")), str(tmp_path / "ckpt"), "pairs",
                     sink="parquet", path=out)
    q.awaitTermination(120)
    snap = latest_snapshot(spark, out)
    want = op.item_counts(bindings.posts(spark, SF_SMALL))
    assert sorted(map(tuple, snap.collect())) == sorted(map(tuple, want.collect()))


def test_popularity_from_the_streamed_snapshot_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    src = tmp_path / "incoming"
    src.mkdir()
    shutil.copy(os.path.join(SF_SMALL, "documents.parquet"), src / "part-0.parquet")
    out = str(tmp_path / "pair_counts")
    q = start_counts(running_counts(read_documents_stream(spark, str(src)), ("item", "grp")),
                     str(tmp_path / "ckpt"), "pairs_for_popularity", sink="parquet", path=out)
    q.awaitTermination(120)
    scored = op.rank_within(op.scored_counts(latest_snapshot(spark, out)), "grp", "popularity_score", "group_rank")
    streamed = scored.select("item", "grp", "review_count", "popularity_score", "group_rank")
    batch = op.popularity_score(bindings.posts(spark, SF_SMALL))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert streamed.where(F.col("group_rank") < 1).count() == 0
