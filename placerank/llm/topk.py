"""Exact top-k by inner product: branch and bound over blocks of dimensions.

Vectors become integers, floor(scale * x), and are stored in blocks of rows, dimension by
dimension (vertically). For a query, the products are added up over ``DIMENSIONS`` dimensions
at a time; what the others can still add is bounded by the norms of the rest (Cauchy-Schwarz).
Candidates whose upper bound is below the k-th best lower bound go, and the rest is compacted
before the next dimensions are read. The survivors' scores are exact.

The stated queries meet all rows block by block: query blocks and candidate blocks are joined
on (query block, slot), a candidate block sits in one slot, a query block in every slot, so that
each task has pairs of bounded blocks and no side is broadcast. Each pair keeps k rows a query;
a window with a group limit merges them.

Defined cases: a vector that is null or holds null or non-finite components, and a row without
vec_id, take no part; missing dimensions of a shorter vector count as 0; an empty vector
scores 0; rows that share the query's vec_id are not its candidates; repeated rows are rows
(repeated queries are answered each); equal scores go to the smaller vec_id; numbers too large
for exact doubles are multiplied as Python integers and cut off at the ends of bigint; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, shuffle_partitions

ROWS, QUERIES, DIMENSIONS = 4096, 1024, 16
_BLOCK = "block bigint, n int, d int, ids binary, data binary"
_EXACT = 2.0**53


def integer_rows(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors (as doubles, padded with 0) of the rows that take part."""
    vectors = batch.column("vec")
    keep = pc.and_(pc.is_valid(vectors), pc.is_valid(batch.column("vec_id")))
    batch = batch.filter(keep)
    vectors = batch.column("vec")
    sizes = np.asarray(pc.list_value_length(vectors), dtype=np.int64)
    flat = pc.list_flatten(vectors)
    values = np.floor(scale * pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False))
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[row, np.arange(len(values)) - (ends - sizes)[row]] = values
    good = np.isfinite(out).all(axis=1)
    return batch.column("vec_id").to_numpy()[good].astype(np.int64), out[good]


def packed(vectors: DataFrame, scale: float, most: int) -> DataFrame:
    """Blocks of up to ``most`` rows, dimensions one after the other."""

    def pack(batches):
        part, turn = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block():
            nonlocal turn
            d = max(v.shape[1] for _, v in held)
            ids = np.concatenate([i for i, _ in held])
            data = np.vstack([np.pad(v, ((0, 0), (0, d - v.shape[1]))) for _, v in held])
            turn += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + turn], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array([d], pa.int32()),
                 pa.array([ids.astype("<i8").tobytes()]), pa.array([np.ascontiguousarray(data.T).astype("<f8").tobytes()])],
                names=["block", "n", "d", "ids", "data"],
            )

        for batch in batches:
            ids, data = integer_rows(batch, scale)
            for i in range(0, len(ids), most):
                held.append((ids[i : i + most], data[i : i + most]))
                while sum(len(x) for x, _ in held) >= most:
                    over = sum(len(x) for x, _ in held) - most
                    last_ids, last = held.pop()
                    cut = len(last_ids) - over
                    held.append((last_ids[:cut], last[:cut]))
                    yield block()
                    held = [(last_ids[cut:], last[cut:])] if over else []
        if held:
            yield block()

    return map_batches(vectors, pack, _BLOCK)


def best(query: np.ndarray, query_id: int, ids: np.ndarray, data: np.ndarray, rest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates of one query. ``data``: dimensions by rows;
    ``rest``: per block of dimensions the candidates' norms of the dimensions after it."""
    alive = np.flatnonzero(ids != query_id)
    if len(alive) == 0:
        return ids[:0], np.zeros(0)
    mine = np.sqrt(np.r_[np.cumsum((query**2)[::-1])[::-1], 0.0])
    score = np.zeros(len(alive))
    for j, at in enumerate(range(0, len(query), DIMENSIONS)):
        stop = min(at + DIMENSIONS, len(query))
        score = score + query[at:stop] @ data[at:stop, alive]
        if stop < len(query) and len(alive) > k:
            slack = mine[stop] * rest[j, alive] * (1 + 1e-9) + 1e-6
            bar = np.partition(score - slack, len(alive) - k)[len(alive) - k]
            stay = score + slack >= bar
            alive, score = alive[stay], score[stay]
    order = np.lexsort((ids[alive], -score))[:k]
    return ids[alive][order], score[order]


def best_exact(query: np.ndarray, query_id: int, ids: np.ndarray, data: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same in Python integers, for numbers beyond exact doubles."""
    q = [int(x) for x in query]
    scored = []
    for c in np.flatnonzero(ids != query_id):
        total = sum(a * int(b) for a, b in zip(q, data[:, c], strict=True))
        scored.append((-max(-(2**63), min(2**63 - 1, total)), int(ids[c])))
    scored.sort()
    return np.array([i for _, i in scored[:k]], dtype=np.int64), [-s for s, _ in scored[:k]]


def search_pair(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """(query row, candidate id, score) of the k best of each query in one pair of blocks;
    both sides dimensions by rows."""
    d = max(q.shape[0], c.shape[0])
    q, c = (np.pad(x, ((0, d - x.shape[0]), (0, 0))) for x in (q, c))
    exact = np.abs(q).max(initial=0.0) * np.abs(c).max(initial=0.0) * max(d, 1) < _EXACT
    squares = np.zeros((d + 1, c.shape[1]))
    squares[:d] = np.cumsum((c**2)[::-1], axis=0)[::-1]
    rest = np.sqrt(squares[np.minimum(np.arange(DIMENSIONS, d + DIMENSIONS, DIMENSIONS), d)])
    row, found, score = [], [], []
    for i in range(q.shape[1]):
        one = np.ascontiguousarray(q[:, i])
        ids, s = best(one, q_ids[i], c_ids, c, rest, k) if exact else best_exact(one, q_ids[i], c_ids, c, k)
        row += [i] * len(ids)
        found += ids.tolist()
        score += [int(x) for x in s]
    return row, found, score


def query_blocks(wanted: DataFrame, scale: float) -> DataFrame:
    """Blocks of the queries. Rows are sorted before they are numbered, whatever order the shuffle
    brings them in: a block that is computed again, after an executor is lost, has the same rows
    in the same places."""
    n_blocks = max(1, -(-wanted.count() // QUERIES))
    dealt = wanted.repartition(n_blocks, F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
    return packed(dealt.sortWithinPartitions("vec_id", "vec"), scale, QUERIES)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, slots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` its k best rows of
    ``vectors``, both (vec_id, vec)."""
    slots = slots or shuffle_partitions(vectors.sparkSession)
    wanted = queries.select(F.col("vec_id").cast("long").alias("vec_id"), "vec")
    q = query_blocks(wanted, scale)
    c = packed(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vec"), scale, ROWS)

    # Query blocks are numbered by the driver (one number each); every one goes to all slots.
    numbers = {b: i for i, b in enumerate(sorted(r["block"] for r in q.select("block").collect()))}
    if not numbers:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    table = vectors.sparkSession.createDataFrame(sorted(numbers.items()), "block bigint, qb int")
    left = q.join(F.broadcast(table), "block").select(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
        F.col("n").alias("qn"), F.col("d").alias("qd"), F.col("ids").alias("qids"), F.col("data").alias("qdata"),
    )
    right = c.select(
        F.explode(F.sequence(F.lit(0), F.lit(len(numbers) - 1))).alias("qb"),
        F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int").alias("slot"), "n", "d", "ids", "data",
    )
    pairs = right.join(left, ["qb", "slot"])

    def search(batches):
        for batch in batches:
            for r in batch.to_pylist():
                c_ids, c_data = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["data"], "<f8").reshape(r["d"], r["n"])
                q_ids, q_data = np.frombuffer(r["qids"], "<i8"), np.frombuffer(r["qdata"], "<f8").reshape(r["qd"], r["qn"])
                row, found, score = search_pair(q_ids, q_data, c_ids, c_data, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), r["qb"], np.int32)), pa.array(row, pa.int32()),
                     pa.array(q_ids[row], pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.int64())],
                    names=["qb", "row", "query_id", "vec_id", "score"],
                )

    found = map_batches(pairs, search, "qb int, row int, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("qb", "row").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
