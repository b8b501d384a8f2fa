"""Document fingerprints from closed syncmers.

A k-mer (K bytes of UTF-8) is a closed syncmer when the smallest of its inner S-mers, by hash,
lies at its first or last place. Whether a k-mer is chosen depends on its own bytes only, so
that the same passage gives the same anchors in any text. The anchors of a text are dealt by
hash into BINS bins; each bin keeps the anchor of smallest hash and its place. The fingerprint
writes, per bin, sixteen bits of that hash (0000: no anchor) and the place modulo 2**16.

Two fingerprints are matched by position: bins with the same anchor agree on how far one text
is shifted against the other; the likeness is the largest number of bins that agree within
DRIFT bytes, over the bins that either text has.

``edited_fingerprints`` also makes each document's edited text: its last floor(n/4) code points
replaced by the first as many of the next document by doc_id (after the last: the first).
Documents are dealt to contiguous ranges of doc_id whose bounds come from one range
partitioning of the ids; the first document of each range is also sent to the range before,
as the neighbour of its last document. What is broadcast is one id per range.

Defined cases: a null text is empty; an empty text has no anchor, and two such texts have
likeness 1; a text without a syncmer has one anchor, itself; rows of equal doc_id follow one
another by text, null ids come first; a single document is its own neighbour; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix64, shuffle_partitions, small_batches

K, S, BINS, DRIFT = 16, 5, 64, 256
LEAST_ID = -(1 << 63)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts: (text number, place, hash). Every non-empty text has one at least."""
    import xxhash

    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint64)
    owner, place, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) >= K:
        n = len(data) - S + 1
        smer = np.zeros(n, dtype=np.uint64)
        for j in range(S):
            smer |= data[j : j + n] << np.uint64(8 * j)
        smer = mix64(smer)
        inner = K - S + 1  # S-mers of a k-mer
        two = np.minimum(smer[:-1], smer[1:])
        four = np.minimum(two[:-2], two[2:])
        eight = np.minimum(four[:-4], four[4:])
        n = len(data) - K + 1
        least = np.minimum(eight[:n], four[inner - 4 : inner - 4 + n])
        chosen = (least == smer[:n]) | (least == smer[inner - 1 : inner - 1 + n])
        text = np.repeat(np.arange(len(texts)), sizes)
        ends = np.repeat(np.cumsum(sizes), sizes)
        at = np.flatnonzero(chosen & (np.arange(n) + K <= ends[:n]))
        owner = text[at]
        place = at - (np.cumsum(sizes) - sizes)[owner]
        value = mix64(smer[at] * np.uint64(3) ^ mix64(smer[at + S] ^ mix64(smer[at + 2 * S] ^ mix64(smer[at + inner - 1]))))
    bare = np.flatnonzero((np.bincount(owner, minlength=len(texts)) == 0) & (sizes > 0))
    if len(bare):
        owner = np.r_[owner, bare]
        place = np.r_[place, np.zeros(len(bare), np.int64)]
        value = np.r_[value, np.array([xxhash.xxh3_64_intdigest(texts[i]) for i in bare], dtype=np.uint64)]
    return owner, place, value


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Fingerprints as 16-bit numbers: texts by bins by (hash, place)."""
    owner, place, value = anchors(texts)
    best = np.full(len(texts) * BINS, _EMPTY, dtype=np.uint64)
    slot = owner * BINS + (value >> np.uint64(58)).astype(np.int64)
    packed = ((value << np.uint64(6)) & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64)
    np.minimum.at(best, slot, packed)
    out = np.zeros((len(texts) * BINS, 2), dtype=">u2")
    there = best != _EMPTY
    out[there, 0] = 1 + ((best[there] >> np.uint64(32)) & np.uint64(0xFFFFF)) % np.uint64(65535)
    out[there, 1] = best[there] & np.uint64(0xFFFF)
    return out.reshape(len(texts), BINS, 2)


def as_text(prints: np.ndarray) -> list[str]:
    return [p.tobytes().hex() for p in prints]


def from_text(prints: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(prints)), dtype=">u2").reshape(len(prints), BINS, 2)


def likeness(a: np.ndarray, b: np.ndarray, drift: int = DRIFT) -> np.ndarray:
    """Likeness of fingerprints, row by row (0 to 1)."""
    either = ((a[:, :, 0] > 0) | (b[:, :, 0] > 0)).sum(axis=1)
    same = (a[:, :, 0] > 0) & (a[:, :, 0] == b[:, :, 0])
    shift = (a[:, :, 1].astype(np.int32) - b[:, :, 1].astype(np.int32) + (1 << 15)) % (1 << 16)
    shift = np.sort(np.where(same, shift, 1 << 30), axis=1)
    agree = np.zeros(len(a), dtype=np.int64)
    for j in range(BINS):  # bins whose shift is at most ``drift`` above the j-th smallest one
        low = shift[:, j : j + 1]
        agree = np.maximum(agree, ((shift >= low) & (shift <= low + drift) & (shift < 1 << 30)).sum(axis=1))
    return np.where(either == 0, 1.0, agree / np.maximum(either, 1))


def _id_bounds(ids: DataFrame, ranges: int) -> np.ndarray:
    """First id of each non-empty range of one range partitioning of the ids."""
    dealt = ids.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("first"))
    return np.array(sorted(r["first"] for r in dealt.collect()), dtype=np.int64)


def edited_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    parts = ranges or shuffle_partitions(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("key"),
    )
    bounds = _id_bounds(rows.select("key"), parts)
    count = max(1, len(bounds))

    def deal(batches):
        for batch in batches:
            key = batch.column("key").to_numpy()
            block = np.searchsorted(bounds, key, side="right") - 1
            first = np.flatnonzero(bounds[block] == key)  # also neighbours of the range before
            both = np.r_[np.arange(len(key)), first]
            out = batch.take(pa.array(both))
            flag = np.r_[np.zeros(len(key), np.int32), np.ones(len(first), np.int32)]
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(np.r_[block, (block[first] - 1) % count].astype(np.int32)), pa.array(flag)],
                names=["doc_id", "text", "key", "block", "flag"],
            )

    def edit(batches):
        held: tuple | None = None  # the last row, which waits for its neighbour
        over = False
        for batch in small_batches(batches, most_bytes=2 << 20):
            got = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                           batch.column("flag").to_pylist(), strict=True))
            if over:
                continue
            stop = next((i for i, r in enumerate(got) if r[2]), None)
            if stop is not None:  # further neighbours are not asked for
                got, over = got[: stop + 1], True
            got = ([held] if held else []) + got
            held = got[-1]
            if len(got) > 1:
                yield _edited(got)

    dealt = map_batches(rows, deal, "doc_id bigint, text string, key bigint, block int, flag int")
    ordered = dealt.repartitionById(count, F.col("block")).sortWithinPartitions("flag", "key", "text")
    return map_batches(
        ordered, edit,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _edited(rows: list[tuple]) -> pa.RecordBatch:
    """Results of all rows but the last, each with the next row as its neighbour."""
    texts = [r[1] for r in rows]
    edited = []
    for text, after in zip(texts[:-1], texts[1:], strict=True):
        k = len(text) // 4
        edited.append((text[: len(text) - k] + after[:k]).encode())
    own = fingerprints([t.encode() for t in texts])
    other = fingerprints(edited)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
         pa.array([hashlib.sha256(t).hexdigest() for t in edited]), pa.array(as_text(own[:-1])), pa.array(as_text(other)),
         pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], own[1:]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )
