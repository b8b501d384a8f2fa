"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Components c of a vector become integers x = floor(256 * c). The covariance V of the distinct
integer vectors (the fit list, n of them) is never formed: one pass over the written fit list
takes a block Q of a few columns to V Q = Xc'(Xc Q) / n, rows centred before they are multiplied,
as sums per task that Spark adds up cell by cell. A Chebyshev polynomial of V, by its three-term
recurrence and one pass a degree, damps the unwanted lower part of the spectrum; QR and a
Rayleigh-Ritz step give eigenvalues and vectors. A few Lanczos steps place the lower end of the
damped part. One column of the block is drawn anew each round, so that a direction that the first
block missed enters. Rounds end when the wanted pairs' residuals |V q - e q| are certified, twice
in a row: to ``TOLERANCE`` of the largest eigenvalue.

Only blocks of (dimensions x columns) numbers reach the driver; a task holds one batch of rows.

Defined cases: rows whose vector is null or empty, or holds a null or non-finite entry, take no
part; nor do vectors of another length than the commonest one (of equally common ones the longest).
Repeated vectors count once in the fit and are each a row of the result; a null vec_id is kept. A
component's eigenvalue has to be above ``LEAST`` of the largest one: constant or single vectors
have no component, and an empty table has no rows. ``deviation`` is null where it does not fit a
long; entries beyond a long are taken as its bounds. Other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, written

BLOCK = 32  # columns of the block
DEGREE = 10  # of the polynomial
LANCZOS = 12  # steps to find the lower end of the spectrum
TOLERANCE = 2e-13  # of a residual, against the largest eigenvalue
FLOOR = 1e-11  # accepted where rounding keeps a residual from falling any further
LEAST = 1e-12
ROUNDS = 100
SEED = 11
_SMALL = 1 << 15


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    sound = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & sound)
    common = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = common.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("vec") == F.lit(first[0]["d"] if first else 0))


def integers(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows x dimensions of floor(256 * c) as 64-bit integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = np.floor(256 * column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dimensions)
    bound = float(1 << 63)
    out = np.where(np.abs(x) < bound, x, 0).astype(np.int64)
    out[x >= bound], out[x <= -bound] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    return out


def packed(rows: DataFrame, dimensions: int) -> DataFrame:
    """(x binary) of every row: 16-bit integers where all entries fit, else 64-bit ones; equal
    vectors have equal bytes."""

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column("vec"), dimensions)
                small = ((x >= -_SMALL) & (x < _SMALL)).all(axis=1)
                data = [(r.astype("<i2") if s else r).tobytes() for r, s in zip(x, small, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["x"])

    return map_batches(rows.select("vec"), pack, "x binary")


def unpacked(column: pa.Array, dimensions: int) -> list[np.ndarray]:
    """Rows of the 16-bit kind, and of the 64-bit kind."""
    data = column.to_pylist()
    kinds = (("<i2", 2 * dimensions), ("<i8", 8 * dimensions))
    return [np.frombuffer(b"".join(r for r in data if len(r) == size), dtype=kind).reshape(-1, dimensions) for kind, size in kinds]


class FitList:
    """The distinct vectors as a written table, and passes over it."""

    def __init__(self, table: DataFrame, dimensions: int):
        self.table, self.dimensions = table, dimensions
        sums = self._whole_sums()
        self.n, self.sums = sums[-1], sums[:-1]
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dimensions)

    def _whole_sums(self) -> list[int]:
        """Sums of each dimension, and the number of vectors, exactly."""
        d = self.dimensions

        def add(batches):
            total = [0] * (d + 1)
            for batch in batches:
                for x in unpacked(batch.column("x"), d):
                    # The halves of an entry add up without overflow in any batch.
                    x = x.astype(np.int64)
                    high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                    total = [t + (h << 32) + u for t, h, u in zip(total, [*high, 0], [*low, len(x)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([str(t) for t in total])], names=["k", "v"])

        parts = map_batches(self.table, add, "k int, v string")
        found = parts.groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
        out = [0] * (d + 1)
        for r in found:
            out[r["k"]] = int(r["v"])
        return out

    def summed(self, fn, cells: int) -> np.ndarray:
        """Sum over the fit list of ``fn(centred rows)``, an array of ``cells`` numbers: summed in
        each task, then cell by cell."""
        d, mean = self.dimensions, self.mean

        def add(batches):
            total = np.zeros(cells)
            for batch in batches:
                for x in unpacked(batch.column("x"), d):
                    if len(x):
                        total += np.ravel(fn(x.astype(np.float64) - mean))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], names=["k", "v"])

        out = np.zeros(cells)
        for r in map_batches(self.table, add, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
            out[r["k"]] = r["v"]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q for a block of columns: one pass."""
        return self.summed(lambda x: x.T @ (x @ q), q.size).reshape(q.shape) / self.n


def lower_end(fit: FitList, start: np.ndarray) -> float:
    """A number that V's smallest eigenvalue is unlikely to be below: Lanczos steps from ``start``,
    the smallest Ritz value less the last coupling."""
    basis, alpha, beta = [start / np.linalg.norm(start)], [], []
    for _ in range(min(LANCZOS, fit.dimensions)):
        w = fit.times(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for _ in range(2):
            for v in basis:
                w = w - (v @ w) * v
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-9 * abs(alpha[0]):
            break
        basis.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def filtered(fit: FitList, q: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of V that stays small on [low, high], scaled at ``top``, times q."""
    half, centre = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (fit.times(q) - centre * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        scale = 1 / (2 / first - sigma)
        before, now = now, (fit.times(now) - centre * now) * (2 * scale / half) - (sigma * scale) * before
        sigma = scale
    return now


def leading_pairs(fit: FitList, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of V, falling, and their unit vectors as columns."""
    d, rng = fit.dimensions, np.random.default_rng(SEED)
    m = min(d, max(BLOCK, 2 * wanted))
    q = np.linalg.qr(rng.standard_normal((d, m)))[0]
    low = lower_end(fit, rng.standard_normal(d)) if m < d else 0.0
    passed, worst_before = 0, np.inf
    for _ in range(ROUNDS):
        image = fit.times(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        worst = float(np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max())
        scale = max(float(values[0]), 0.0)
        fine = worst <= TOLERANCE * scale or (worst <= FLOOR * scale and worst > worst_before / 2)
        passed, worst_before = (passed + 1 if fine else 0), worst
        if m == d or passed == 2 or scale == 0:
            return values[:wanted], q[:, :wanted]
        # The damped part ends below the wanted values, at the block's last but one Ritz value.
        high = min(float(values[-2]), float(values[wanted - 1]) * (1 - 1e-9))
        q[:, -1] = rng.standard_normal(d)
        if high > low and values[0] > high:
            q = filtered(fit, q, low, high, float(values[0]))
        else:
            q = np.hstack([q[:, :wanted], image[:, wanted:-1], q[:, -1:]])
        q = np.linalg.qr(np.linalg.qr(q)[0])[0]
    raise RuntimeError(f"residual {worst_before} after {ROUNDS} rounds of the subspace iteration")


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row of
    ``vectors`` (vec_id, vec) that takes part and each of the leading ``components``."""
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    spark = vectors.sparkSession
    rows = usable(vectors)
    one = rows.select(F.size("vec").alias("d")).limit(1).collect()
    if not one:
        return spark.createDataFrame([], schema)
    d = one[0]["d"]
    fit = FitList(written(packed(rows, d).dropDuplicates(["x"]), "fit-list"), d)
    trace = float(fit.summed(lambda x: np.array([(x * x).sum()]), 1)[0]) / fit.n
    values, q = leading_pairs(fit, min(components, d))
    keep = (values > LEAST * values[0]) & (values > d * np.finfo(float).eps * trace) & (np.arange(len(values)) < fit.n - 1)
    values, q = values[keep], q[:, keep]
    k = len(values)
    if k == 0:
        return spark.createDataFrame([], schema)
    onto, mean, n, sums = q / np.sqrt(values), fit.mean, fit.n, fit.sums
    moments = fit.summed(lambda x: np.vstack([(x @ onto).T @ (x @ onto), (x @ onto).sum(axis=0)]), k * k + k).reshape(k + 1, k) / n
    error = float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())
    explained = values / trace

    def project(batches):
        s, most = np.array(sums, dtype=object), max(map(abs, sums))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = integers(batch.column("vec"), d)
            largest = max(int(x.max()), -int(x.min()))
            if (n * largest + most) ** 2 * d < 1 << 63:
                off = n * x - s.astype(np.int64)
                deviation = (off * off).sum(axis=1).tolist()
            else:
                off = n * x.astype(object) - s
                deviation = [v if v < 1 << 63 else None for v in (off * off).sum(axis=1)]
            white = (x.astype(np.float64) - mean) @ onto
            ids = batch.column("vec_id").to_pylist()
            size = len(ids) * k
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i in ids for _ in range(k)], pa.int64()), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                 pa.array(np.full(size, n)), pa.array([v for v in deviation for _ in range(k)], pa.int64()), pa.array(white.ravel()),
                 pa.array(np.tile(explained, len(ids))), pa.array(np.full(size, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_batches(rows, project, schema)
