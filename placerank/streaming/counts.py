"""The counting operators over a stream of posts (Structured Streaming).

The reference has no streaming. Its counts (posts per item, per group, per period; the
(item, grp) counts behind popularity) are plain grouped counts, which Structured
Streaming maintains incrementally with the same semantics; this module only provides the
stream source and the sink wiring. Top-k, min-max scaling and ranks need the whole table
at once, so they are computed from a written snapshot of these counts with the batch
operators, not in the stream.

State is kept per key in the state store; the checkpoint location must be on a shared,
fault-tolerant file system so that a restarted query resumes exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import POSTS
from ..sources.bindings import POSTS_EXPRS

DOCUMENT_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def read_posts_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of canonical posts from files arriving under ``path``."""
    reader = spark.readStream.format(fmt).schema(POSTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def read_documents_stream(spark: SparkSession, path: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Documents files as a stream of posts (the ``posts`` binding, applied per batch)."""
    reader = spark.readStream.format("parquet").schema(DOCUMENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).selectExpr(*POSTS_EXPRS)


def running_counts(posts: DataFrame, keys: Sequence[str] = ("grp",)) -> DataFrame:
    """Posts per key, maintained incrementally: (keys..., review_count)."""
    return posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("review_count"))


def start_counts(counts: DataFrame, checkpoint_location: str, query_name: str,
                 sink: str = "parquet", path: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start a counting query in complete mode. Every batch writes, through
    ``foreachBatch``, a full snapshot of the counts to its own folder ``path/batch=<id>``: a
    reader of ``latest_snapshot`` never sees a half-written one, and a batch that runs again
    replaces its own. ``sink="memory"`` keeps the counts as a table named ``query_name`` on
    the driver: for tests and notebooks only. ``available_now`` processes what is there and
    stops."""
    writer = counts.writeStream.queryName(query_name).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if sink == "memory":
        return writer.outputMode("complete").format("memory").start()
    if path is None:
        raise ValueError("path is required for a file sink")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(sink).save(f"{path}/batch={batch_id}")

    return writer.outputMode("complete").foreachBatch(write_batch).start()


def latest_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest finished snapshot under ``path``: the counts after that batch. A snapshot is
    finished once its writer has committed it (its ``_SUCCESS`` file)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    found = [str(f.getPath().getParent()) for f in done.getFileSystem(conf).globStatus(done)]
    if not found:
        raise ValueError(f"no finished snapshot under {path}")
    return spark.read.format(fmt).load(max(found, key=lambda p: int(p.rpartition("=")[2])))
