import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF01

from linewise.llm import queries
from linewise.llm.whitening import refined_eigenvectors, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, k=4):
    """x, distinct x, n, S, covariance and eigenvectors straight from numpy in double precision."""
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    v = c.T @ c / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    deviation = ((n * x - s) ** 2).sum(axis=1)
    return n, deviation, np.abs((x - s / n) @ basis[:, :k] / np.sqrt(values[:k])), values[:k] / np.trace(v)


def test_query_equals_brute_force(spark):
    table = pq.read_table(f"{SF01}/embeddings.parquet").to_pylist()
    table.sort(key=lambda r: r["vec_id"])
    n, deviation, whitened, explained = brute([r["embedding"] for r in table])
    rows = queries.op11_whitening(spark, SF01).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in rows] == [(t["vec_id"], k) for t in table for k in range(1, 5)]
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert [r.deviation for r in rows[::4]] == deviation.tolist()
    np.testing.assert_allclose(np.abs([r.whitened for r in rows]), whitened.ravel(), rtol=0, atol=1e-9)
    np.testing.assert_allclose([r.explained for r in rows[:4]], explained, rtol=1e-12)
    assert rows[0].identity_error < 1e-10


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1, 0.5], [5, 5, 5, 1, 1, 1], [1 + 1e-7, 1, 1 - 1e-7, 0.3, 0.3 + 1e-12, 0], [1, 1e-4, 1e-8, 1e-12, 0, 0],
    [2, 2, 2, 2, 2, 2], [1 + 1e-9, 1, 1 + 2e-9, 1 + 3e-9, 1 - 1e-9, 1 - 2e-9], [0, 0, 0, 0, 0, 0], [1e300, 1e299, 1, 1, 1, 1]])
def test_refinement_reaches_double_precision(values):
    q = np.linalg.qr(np.random.default_rng(3).normal(size=(6, 6)))[0]
    a = (q * np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    got, x = refined_eigenvectors(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.all(np.diff(got) <= 0)
    assert np.abs(x.T @ x - np.eye(6)).max() < 4e-16 * 6
    assert np.abs(a @ (x / 1) - x * got).max() / size < 1e-14
    assert np.abs(got - np.maximum(np.linalg.eigvalsh(a)[::-1], 0)).max() / size < 1e-14


def test_float32_alone_would_not_do():
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(64, 64)))[0]
    a = (q * np.linspace(1, 2, 64)) @ q.T
    x = refined_eigenvectors((a + a.T) / 2)[1]
    assert np.abs(np.abs(x.T @ q[:, ::-1]) - np.eye(64)).max() < 1e-13


def test_cases(spark):
    rng = np.random.default_rng(0)
    good = [[float(v) for v in r] for r in rng.integers(-300, 300, (60, 5)) / 256]
    rows = [(i, v, None) for i, v in enumerate(good)] + [(0, good[0], 1), (None, good[1], 1)]
    bad = [(100, None, 1), (101, [1.0, None, 1.0, 1.0, 1.0], 1), (102, [float("nan")] * 5, 1), (103, [float("inf")] * 5, 1),
           (104, [], 1), (105, [1.0] * 4, 1), (106, [3e38] * 5, 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumnRenamed("label", "whitened").repartition(4)
    out = whiten(df, components=3).collect()
    assert len(out) == 3 * len(rows) and all(r.vec_id is None or r.vec_id < 100 for r in out)
    n, deviation, whitened, _ = brute(good, 3)
    by = {(r.vec_id, r.component): r for r in out}
    for i in range(60):
        assert by[i, 1].deviation == deviation[i] and by[i, 1].n == n
        assert abs(abs(by[i, 2].whitened) - whitened[i, 1]) < 1e-9
    assert sum(r.vec_id == 0 for r in out) == 6 and by[None, 1].whitened == by[1, 1].whitened


def test_tables_without_variance_or_rows(spark):
    one = whiten(spark.createDataFrame([(1, [0.5, -0.5], 0), (2, [0.5, -0.5], 0)], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 4
    line = whiten(spark.createDataFrame([(i, [i / 256, 2 * i / 256], 0) for i in range(5)], SCHEMA)).orderBy("vec_id", "component")
    rows = line.collect()
    assert [r.whitened is None for r in rows] == [False, True] * 5 and rows[0].identity_error < 1e-12
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty).collect() == [] and whiten(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []


def test_large_values_stay_exact(spark):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate([[1e15, 1.0], [-1e15, 2.0], [0.0, 3.0]])]
    out = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1).collect()
    assert all(r.deviation is None for r in out if r.vec_id < 2)
    assert {r.deviation for r in out if r.vec_id == 2} == {9}
