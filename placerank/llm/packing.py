"""Packing documents into sequences by patterns, fitted with non-negative least squares.

The lengths of all pieces make a histogram with at most ``capacity`` entries, the only thing
the driver sees. Patterns of few lengths (in classes of ``width`` tokens, at most ``depth``
pieces) that fit a sequence are enumerated; repeat counts that explain the histogram best are
found by non-negative least squares and rounded down; what they leave is packed best-fit,
longest first, into the rooms left in those patterns and into new sequences. The plan is a
table of slots (length, ranks from-to, first sequence, offset) whose size follows the
capacity, not the data. Pieces of a length are numbered on Spark and take the slot of their
rank.

Numbering: a length may be shared by most pieces, so that each length is split by a hash into
about the square root of its number of pieces; the parts' counts are prefix-summed per length,
and pieces numbered inside their part.

Defined cases: a null or empty text is the end id alone; longer documents are cut into whole
sequences and a rest; repeated rows are packed each for itself; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, small_batches, written
from .tokenize import encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces_of(docs: DataFrame, tokenizer: str, kind: str = "word_end", end_id: int = 1,
              capacity: int = 4096) -> DataFrame:
    """One row per piece of each document: whole sequences of ``capacity`` ids, then the rest."""

    def cut(batches):
        enc = encoder(tokenizer, kind)
        for batch in small_batches(batches):
            rows: list[tuple] = []
            ids = enc.encode(batch.column("text").to_pylist(), end_id)
            for doc, data in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc, k, at >> 2, len(part) >> 2, zlib.crc32(part)))
            doc, k, start, length, crc = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(k, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, cut, PIECES)


def patterns(classes: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of 1 to ``depth`` classes whose sum is exactly ``classes``."""
    out: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], room: int, largest: int) -> None:
        left = depth - len(chosen)
        if room == 0:
            out.append(chosen)
        elif left:
            for c in range(min(room, largest), -(-room // left) - 1, -1):
                extend((*chosen, c), room - c, c)

    extend((), classes, classes)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, dtype=bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)
            x[at] += step.min() * (z - x[at])
            x[at[x[at] <= 1e-12]] = 0
            passive = x > 0
            if not passive.any():
                break
    return x


class Sequences:
    """Sequences that are filled alike: ``count`` of them hold ``lengths`` and have ``room``."""

    __slots__ = ("lengths", "count", "room")

    def __init__(self, lengths: tuple[int, ...], count: int, room: int):
        self.lengths, self.count, self.room = lengths, count, room


def plan(histogram: dict[int, int], capacity: int = 4096, width: int = 32, depth: int = 4,
         slack: int = 2) -> list[Sequences]:
    """Sequences for a histogram {length: number of pieces}, lengths from 1 to capacity. A
    pattern is used only as long as it leaves at most ``slack`` tokens of a sequence empty."""
    left = {n: c for n, c in histogram.items() if c > 0}
    done: list[Sequences] = []
    if full := left.pop(capacity, 0):
        done.append(Sequences((capacity,), full, 0))
    open_: dict[int, list[Sequences]] = {}

    classes = capacity // width
    wanted = np.zeros(classes)
    for n in sorted(left):
        wanted[-(-n // width) - 1] += left[n]
    shapes = patterns(classes, depth)
    a = np.zeros((classes, len(shapes)))
    for j, shape in enumerate(shapes):
        for c in shape:
            a[c - 1, j] += 1
    # Short pieces fit anywhere: leaving some of them to the best-fit step costs little.
    weigh = np.where(np.arange(1, classes + 1) <= classes // 16, 0.1, 1.0)
    repeats = np.floor(nnls(a * weigh[:, None], wanted * weigh, 3 * classes)).astype(np.int64)

    lengths = sorted(left)

    def longest(most: int, need: dict[int, int]) -> int:
        """The longest length up to ``most`` with a piece left beyond ``need``; 0: none."""
        at = bisect_right(lengths, most) - 1
        while at >= 0 and left[lengths[at]] <= need.get(lengths[at], 0):
            at -= 1
        return lengths[at] if at >= 0 else 0

    for j in sorted(np.flatnonzero(repeats), key=lambda j: (-a[:, j].max(), shapes[j])):
        times = int(repeats[j])
        while times > 0:
            # Each slot but the last takes the longest piece of its class, the last one the
            # longest piece that still fits; as often as all these lengths last.
            need: dict[int, int] = {}
            chosen, room = [], capacity
            for k, c in enumerate(shapes[j]):
                n = longest(room if k == len(shapes[j]) - 1 else min(room, c * width), need)
                if n == 0:
                    break
                need[n] = need.get(n, 0) + 1
                chosen.append(n)
                room -= n
            if not chosen or room > slack:  # its lengths have run out: left to the best-fit step
                break
            k = min([times, *(left[n] // m for n, m in need.items())])
            for n, m in need.items():
                left[n] -= k * m
            times -= k
            open_.setdefault(room, []).append(Sequences(tuple(chosen), k, room))

    rooms = sorted(open_)
    for n in sorted(left, reverse=True):
        pieces = left[n]
        while pieces:
            at = bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                group = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
                each = room // n
                used = min(group.count, pieces // each)
                if used == 0:  # the last few go into one sequence
                    each, used = pieces, 1
                if group.count > used:
                    if room not in open_:
                        open_[room] = []
                        insort(rooms, room)
                    open_[room].append(Sequences(group.lengths, group.count - used, room))
                filled = group.lengths
            else:
                each = min(capacity // n, pieces)
                used, room, filled = pieces // each, capacity, ()
            pieces -= used * each
            rest = room - n * each
            if rest not in open_:
                open_[rest] = []
                insort(rooms, rest)
            open_[rest].append(Sequences(filled + (n,) * each, used, rest))
    return done + [g for room in sorted(open_) for g in open_[room]]


def slots(groups: list[Sequences], capacity: int) -> dict[str, np.ndarray]:
    """The plan as slots ordered by (length, first rank): a piece of that length and a rank of
    at least ``rank`` (and below the next slot's) is in sequence first + rank - slot's rank."""
    rows, taken, first = [], [0] * (capacity + 1), 0
    for g in groups:
        offset = 0
        for n in g.lengths:
            rows.append((n, taken[n], first, offset))
            taken[n] += g.count
            offset += n
        first += g.count
    rows.sort()
    length, rank, sequence, offset = (np.array(c, dtype=np.int64) for c in (zip(*rows, strict=True) if rows else [[]] * 4))
    return {"length": length, "rank": rank, "sequence": sequence, "offset": offset}


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Pieces with sequence_id and offset. ``pieces`` (columns of ``pieces_of``) is read twice:
    pass a written table."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(plan(histogram, capacity), capacity)
    # One row a length, at most ``capacity`` rows: a bounded broadcast.
    parts = pieces.sparkSession.createDataFrame(
        [(int(n), math.isqrt(c - 1) + 1) for n, c in histogram.items()], "length bigint, _parts bigint"
    )
    key = F.xxhash64("doc_id", "piece", "ids_crc32", "start")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("_part", F.pmod(key, F.col("_parts"))).drop("_parts")
    counts = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("length").alias("_l"), F.col("_part").alias("_p"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    number = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (
        dealt.withColumn("_at", number - 1)
        .join(bases, (F.col("length") == F.col("_l")) & (F.col("_part") == F.col("_p")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_base") + F.col("_at")).alias("rank"))
    )

    def place(batches):
        at_length = np.searchsorted(table["length"], np.arange(capacity + 2))
        step = np.int64(1) << 44
        keys = table["length"] * step + table["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            slot = np.searchsorted(keys, length * step + rank, side="right") - 1
            slot = np.maximum(slot, at_length[length])
            sequence = table["sequence"][slot] + rank - table["rank"][slot]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(table["offset"][slot])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return map_batches(ranked, place, PIECES + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, kind: str = "word_end", end_id: int = 1,
                   capacity: int = 4096) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text); the piece table without ids is written."""
    return pack(written(pieces_of(docs, tokenizer, kind, end_id, capacity), "pieces"), capacity)
