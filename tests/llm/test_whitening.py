"""Whitening against a dense eigen-decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from placerank.llm import whitening
from placerank.llm.whitening import whiten

from .conftest import SF

VECTORS = "vec_id bigint, vec array<float>, component int, x string, k string"


def dense(vectors, components=4):
    """Per row (in order) the whitened values up to sign, shares, n and deviations."""
    x = np.floor(256 * np.array(vectors, dtype=np.float32).astype(float))
    fit = np.unique(x, axis=0)
    n, centred = len(fit), fit - fit.mean(axis=0)
    values, q = np.linalg.eigh(centred.T @ centred / n)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    exact = [[int(v) for v in row] for row in x]
    sums = [int(s) for s in fit.sum(axis=0)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in exact]
    return (x - fit.mean(axis=0)) @ q / np.sqrt(values), values / np.trace(centred.T @ centred / n), n, deviation


def compare(spark, vectors, components=4):
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in enumerate(vectors)], VECTORS).repartition(3)
    rows = whiten(df, components).orderBy("vec_id", "component").collect()
    want, shares, n, deviation = dense(vectors, components)
    k = want.shape[1]
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    assert [r["component"] for r in rows] == list(range(1, k + 1)) * len(vectors)
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-8
    assert {r["n"] for r in rows} == {n}
    assert [r["deviation"] for r in rows[::k]] == deviation
    assert np.allclose([r["explained"] for r in rows[:k]], shares, rtol=1e-10)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9


def test_small_dimension_is_one_step(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((60, 6)).round(2).tolist()
    compare(spark, vectors + vectors[:7], 4)


def test_filter_finds_the_leading_vectors_of_a_wide_block(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 10)
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((400, 48)) * np.linspace(1, 2, 48)).astype(np.float32).tolist()
    compare(spark, vectors)


def test_equal_eigenvalues_give_an_orthonormal_pair(spark):
    cross = [[s * float(i == j) for j in range(6)] for i in range(6) for s in (1, -1)]
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in enumerate(cross)], VECTORS)
    rows = whiten(df).orderBy("vec_id", "component").collect()
    assert len(rows) == 12 * 4 and rows[0]["identity_error"] < 1e-9
    assert np.allclose([r["explained"] for r in rows], 1 / 6)


def test_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((30, 5)).round(3).tolist()
    odd = [None, [], [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, None, None, None) for i, v in enumerate(good + odd)] + [(None, good[0], None, None, None)]
    got = whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == 31 * 4 and {r["n"] for r in got} == {30}
    assert sorted(r["component"] for r in got if r["vec_id"] is None) == [1, 2, 3, 4]


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in enumerate(vectors)], VECTORS)
    assert whiten(df).count() == 0


def test_large_entries_stay_exact(spark):
    vectors = [[2.0**20 * i, float(-i), 3.0 * i * i] for i in range(9)] + [[2.0**45, 1.0, 5.0], [1e30, 0.0, 0.0]]
    got = whiten(spark.createDataFrame([(i, v, 1, "a", "b") for i, v in enumerate(vectors)], VECTORS), 1).collect()
    assert len(got) == len(vectors) and {r["n"] for r in got} == {11}
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in got)


def test_shared_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec")).orderBy("vec_id").collect()
    compare(spark, [r["vec"] for r in rows])
