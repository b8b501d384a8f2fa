"""Helpers shared by the training-data operators: words, batches, written tables."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# The word of every contract: a run of bytes that are not one of \x20 \x09-\x0D. bytes.split()
# with no argument cuts at exactly those six bytes, in UTF-8 as in ASCII.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.
    Only where none is set (tests, one machine) a scratch folder is made."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="placerank-llm-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back: cuts the
    lineage, survives lost executors, and is read as often as needed."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """``df`` with every column but the ``used`` ones under a name by its place, so that no name of a
    caller meets an operator's own. Places stay: ``out.toDF(*df.columns)`` gives the names back."""
    return df.toDF(*[c if c in used else f"other{i}" for i, c in enumerate(df.columns)])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def small_batches(batches: Batches, column: str = "text", most_bytes: int = 4 << 20) -> Batches:
    """The same rows in batches of about ``most_bytes`` of text each (a longer text alone), so
    that what a task makes of a batch stays small however many rows Spark sends at once."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
    return_freed()


_MEMORY: dict[tuple, dict] = {}


def worker_memory(owner: tuple) -> dict:
    """What this Python worker remembers for ``owner`` (an operator and its model) from batch to
    batch and task to task. One owner at a time: the next one's memory replaces it, so that a reused
    worker never holds the memories of all stages at once. Owners bound their own by bytes."""
    if owner not in _MEMORY:
        _MEMORY.clear()
        gc.collect()
        return_freed()
        _MEMORY[owner] = {}
    return _MEMORY[owner]


def return_freed() -> None:
    """Give freed memory back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def words_of(text: bytes) -> list[bytes]:
    """Words as they are."""
    return text.split()


def lower_words_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased (bytes.lower changes ASCII letters only)."""
    return text.lower().split()


def ragged(lengths: np.ndarray) -> np.ndarray:
    """Offsets (n + 1) of consecutive runs of the given lengths."""
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser, a bijection on 64-bit values."""
    x = np.atleast_1d(np.asarray(x, dtype=np.uint64))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_AT_ONCE = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n; kept by the worker unless a single long
    word needs more than a batch does."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        if size > 2 * _AT_ONCE:
            return both[0], both[1]
        _POWERS.clear()
        _POWERS[size] = (both[0], both[1])
    return _POWERS[size]


class HashedWords:
    """The words of texts as 64-bit hashes, found and hashed without making a string of each: a
    word's hash is its bytes' polynomial modulo 2**64, mixed. ``sizes``: words of each text."""

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join([b"", *texts, b""])
        raw = np.frombuffer(self.data, dtype=np.uint8)
        space = _SPACE[raw]
        self.starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        self.ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        self.hashes = np.zeros(len(self.starts), dtype=np.uint64)
        first = 0
        while first < len(self.starts):  # some megabytes at a time; a longer word alone
            at = int(self.starts[first])
            last = max(first + 1, int(np.searchsorted(self.ends, at + _AT_ONCE, side="right")))
            starts, ends = self.starts[first:last] - at, self.ends[first:last] - at
            part = raw[at : at + int(ends[-1])]
            powers, inverse = _powers(len(part))
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[: len(part)], out=sums[1:])
            self.hashes[first:last] = mix64((sums[ends] - sums[starts]) * inverse[starts])
            first = last
        bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
        self.sizes = np.diff(np.searchsorted(self.starts, bounds))

    def words(self, first: int, last: int) -> bytes:
        """Words first to last - 1 of all texts, joined by one blank."""
        return b" ".join(self.data[self.starts[first] : self.ends[last - 1]].split())
