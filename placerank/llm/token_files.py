"""Token ids of documents in ORC files.

``write_token_ids`` range-partitions the documents on doc_id, tokenises whole texts, appends
the end id and writes one row per document, in ascending doc_id order from file to file and
inside each file. The files hold integers under ORC's run-length encodings, row indexes and
Bloom filters on doc_id, so that a reader takes stripes in parallel (``read_token_ids``) and a
look-up by doc_id skips files, stripes and row groups by their metadata.

Defined cases: a null or empty text has the end id alone; repeated rows and repeated doc_ids
are each a document (ordered by text); a null doc_id comes first; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, shuffle_partitions, small_batches
from .tokenize import encoder

TOKEN_SCHEMA = "doc_id bigint, part int, pos bigint, ids array<int>"
ORC_OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}


def tokenised(docs: DataFrame, path: str, kind: str, end_id: int) -> DataFrame:
    """(doc_id, part, pos, ids) of ``docs`` as they are dealt to tasks: ``part`` is the task's
    partition and ``pos`` the row's place in it."""

    def encode(batches):
        enc = encoder(path, kind)
        part, pos = TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, most_bytes=8 << 20):
            ids = enc.encode(batch.column("text").to_pylist(), end_id)
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) >> 2 for x in ids], out=offsets[1:])
            values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(np.full(n, part, dtype=np.int32)),
                 pa.array(np.arange(pos, pos + n, dtype=np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), values)],
                names=["doc_id", "part", "pos", "ids"],
            )
            pos += n

    return map_batches(docs.select("doc_id", "text"), encode, TOKEN_SCHEMA)


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, kind: str = "byte_level", end_id: int = 2,
                    partitions: int | None = None) -> None:
    """Write the token ids of ``docs`` (doc_id, text) as ORC files under ``path``."""
    parts = partitions or shuffle_partitions(docs.sparkSession)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    tokenised(ordered, tokenizer, kind, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_token_ids(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The rows of token files, those of doc_id ``first`` to ``last`` if given: the bounds reach
    the ORC reader, which skips what their statistics rule out."""
    rows = spark.read.schema(TOKEN_SCHEMA).orc(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("doc_id") <= F.lit(last))
    return rows


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, part, pos, n_tokens, ids_crc32) of token rows."""

    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy().astype(np.int64)
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False)).astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("pos"),
                 pa.array(np.diff(offsets)), pa.array(crc, type=pa.int64())],
                names=["doc_id", "part", "pos", "n_tokens", "ids_crc32"],
            )

    schema = "doc_id bigint, part int, pos bigint, n_tokens bigint, ids_crc32 bigint"
    return map_batches(rows.select("doc_id", "part", "pos", "ids"), digest, schema)


def with_starts(digested: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all rows before, in (part, pos) order. Sums per part (one row a
    part) are prefix-summed on their own; inside a part a window adds the rest. ``digested`` is
    read twice: pass a written table."""
    parts = digested.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    local = digested.withColumn("_local", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return local.join(bases, "part").select(
        "doc_id", (F.col("_base") + F.col("_local")).alias("start"), "n_tokens", "ids_crc32"
    )
