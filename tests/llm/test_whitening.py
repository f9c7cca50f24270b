"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from millrace.llm import whitening as wh


def dense(rows, components=16):
    """rows: (id, vector). Results by numpy's own eigenvectors, the sign open."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], np.int64)
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    centred = u - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    return [i for i, _ in kept], n, deviation, (x - sums / n) @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(spark, rows, components=16):
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, n int, x int, component int")
    got = wh.whiten(df).toPandas()
    ids, n, deviation, whitened, explained = dense(rows)
    k = whitened.shape[1]
    assert sorted(got["vec_id"]) == sorted(i for i in ids for _ in range(k)) and set(got["n"]) == {n} and got["identity_error"].max() < 1e-10 and got["identity_error"].nunique() == 1
    at = got.sort_values(["vec_id", "component", "whitened"]).reset_index(drop=True)
    order = sorted(range(len(ids)), key=lambda j: ids[j])
    mine = at["whitened"].to_numpy().reshape(-1, k)
    signs = np.sign((mine * whitened[order]).sum(axis=0))
    assert np.abs(mine * signs - whitened[order]).max() < 1e-8
    assert at["deviation"].tolist() == [deviation[j] for j in order for _ in range(k)]
    assert np.abs(at["explained"].to_numpy().reshape(-1, k) - explained).max() < 1e-12


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 100)) @ rng.standard_normal((100, 100)) / 8
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[5].tolist()) for i in range(200)])


def test_few_dimensions_and_dropped_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 3)) * [3, 2, 1])]
    check(spark, rows + [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 1.0]), (103, [float("inf"), 0.0, 1.0]), (104, [])])


def test_no_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert wh.whiten(spark.createDataFrame([], schema)).collect() == []
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], schema)).collect() == []
    flat = wh.whiten(spark.createDataFrame([(i, [float(i), 5.0, 5.0]) for i in range(10)], schema)).collect()
    assert {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12
    with pytest.raises(Exception, match="vectors of"):
        wh.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema)).collect()


def test_lobpcg_with_many_dimensions():
    """More dimensions than three blocks: an iteration, with residuals that certify it."""
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    e = 1.05 ** -np.arange(300.0)
    a = (q * e) @ q.T
    values, vectors, residual, _ = wh.lobpcg(lambda b: a @ b, 300, 16)
    assert np.abs(values - e[:16]).max() < 1e-12 and residual < 1e-11
    assert np.abs(np.abs((vectors * q[:, :16]).sum(axis=0)) - 1).max() < 1e-12


def test_deviations_beyond_products_of_longs():
    x = np.array([[1_000_100, 999_900]])
    n = 10**7
    sums = [1_000_000 * n + 3, 1_000_000 * n - 7]
    assert wh.deviations(x, n, sums) == [sum((n * int(a) - s) ** 2 for a, s in zip(x[0], sums))]
    with pytest.raises(OverflowError):
        wh.deviations(x, 10**9, [s * 100 for s in sums])
