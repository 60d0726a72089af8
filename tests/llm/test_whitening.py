"""Whitening against numpy's eigenvectors of the covariance, exact deviations, and odd tables."""

import math

import numpy as np
import pytest

from ledgermill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, row string, x long, whitened double"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "r", 1, 2.0) for i, v in enumerate(vectors)], schema)


def plain(vectors):
    """x by vec_id, and the distinct vectors."""
    ok = lambda v: v and all(c is not None and math.isfinite(c) for c in v)
    lengths = [len(v) for v in vectors if ok(v)]
    common = max(lengths, key=lengths.count)
    x = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in enumerate(vectors) if ok(v) and len(v) == common}
    return x, sorted(set(x.values()))


def check(spark, vectors, k=4):
    x, fit = plain(vectors)
    got = whitening.components(table(spark, vectors).repartition(3), k=k).collect()
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - s / n for c, s in zip(v, sums)] for v in fit])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    there = int(min(k, (values > values[0] * 1e-12).sum()))
    assert len(got) == there * len(x) and {r["component"] for r in got} == set(range(1, there + 1))
    by = {(r["vec_id"], r["component"]): r for r in got}
    for j in range(there):
        want = {i: float((np.array(v) - np.array(sums) / n) @ basis[:, j] / math.sqrt(values[j])) for i, v in x.items()}
        some = max(want, key=lambda i: abs(want[i]))
        sign = math.copysign(1, want[some] * by[some, j + 1]["whitened"])
        for i in x:
            r = by[i, j + 1]
            assert r["whitened"] == pytest.approx(sign * want[i], abs=1e-7) and r["n"] == n
            assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x[i], sums))
            assert r["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-9) and r["identity_error"] < 1e-9
    return got


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 9)) * np.arange(1, 10) / 9 + 5).tolist()
    check(spark, vectors + vectors[:40] + [None, [], [1.0] * 8 + [None], [1.0] * 8 + [float("nan")], [float("inf")] + [0.0] * 8, [1.0] * 8])


def test_few_dimensions_and_no_rank(spark):
    rng = np.random.default_rng(4)
    check(spark, rng.normal(size=(50, 2)).tolist())
    line = [[float(t), 2.0 * t, -float(t), 0.0] for t in range(30)]
    assert {r["component"] for r in check(spark, line)} == {1}


def test_nothing_to_fit(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5):
        got = whitening.components(table(spark, vectors))
        assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_rows_keep_their_columns_and_ids_may_be_odd(spark):
    rows = [(None, [1.0, 2.0], "r", 1, 0.0), (1, [3.0, 1.0], None, 1, 0.0), (1, [0.0, 1.5], "r", None, 0.0), (None, [1.0, 2.0], "r", 1, 0.0)]
    found, fitted = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert fitted.n == 3 and found.count() == 4 and found.select("row.*").columns == ["vec_id", "embedding", "row", "x", "whitened"]


def test_large_entries(spark):
    rows = [[1e9, -1e9, 3.0], [1e9, 1e9, 1.0], [-1e9, 0.5, 2.0], [3e38, 1.0, 1.0]]
    found, fitted = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>"))
    got = {r["row"]["vec_id"]: r["deviation"] for r in found.collect()}
    assert got == {0: None, 1: None, 2: None, 3: None} and fitted.n == 4  # all pass 64 bits
    exact = whitening.deviations(np.array([[3_000_000_000, 1], [-5, 2]]), 2, [2_999_999_995, 3])
    assert exact == [(2 * 3_000_000_000 - 2_999_999_995) ** 2 + 1, (-10 - 2_999_999_995) ** 2 + 1]


def test_means_far_from_zero_cost_no_digits():
    x = np.array([[10**15 + 1], [10**15 + 2], [10**15 + 4]])
    assert whitening.centred(x, 3, [3 * 10**15 + 7])[:, 0] == pytest.approx([-4 / 3, -1 / 3, 5 / 3], rel=1e-12)
