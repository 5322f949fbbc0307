"""Whitening against numpy's eigenvectors, exact integers, and hard spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from canvass.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows):
    """Rows by id: x as Python integers, sums, covariance in exact fractions turned to floats."""
    x = {k: [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for k, v in rows}
    n = len(x)
    sums = [sum(c) for c in zip(*x.values(), strict=True)]
    off = [[n * a - s for a, s in zip(v, sums, strict=True)] for v in x.values()]
    cov = np.array([[float(Fraction(sum(o[i] * o[j] for o in off), n**3)) for j in range(len(sums))] for i in range(len(sums))])
    return x, n, sums, cov


def compare(df, rows, k=32):
    x, n, sums, cov = plain(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = df.collect()
    assert len(got) == len(rows) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n
        assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert abs(r.explained / (values[r.component - 1] / np.trace(cov)) - 1) < 1e-9
        assert r.identity_error < 1e-9
    signs = {}
    for key, found in by.items():
        assert sorted(found) == list(range(1, k + 1))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x[key], sums, strict=True)])
        for c, r in found.items():
            want = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            if abs(want) > 1e-6:
                assert signs.setdefault(c, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
            assert abs(abs(want) - abs(r.whitened)) < 1e-8


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    compare(w.embedding_whitening(df.repartition(7)), rows)


def test_unusable_vectors_and_repeats(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=3).tolist(), 0) for i in range(40)]
    bad = [(90, None, 0), (91, [1.0, None, 2.0], 0), (92, [1.0, math.nan, 2.0], 0), (93, [math.inf, 0.0, 0.0], 0)]
    bad += [(94, [1.0, 2.0], 0), (95, [], 0), (96, [1e30, 0.0, 0.0], None)]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(4)
    compare(w.embedding_whitening(df), [r[:2] for r in good], 3)
    twice = w.embedding_whitening(df.union(df)).groupBy("vec_id").count().collect()
    assert {r["count"] for r in twice} == {6} and len(twice) == 40
    none = w.embedding_whitening(spark.createDataFrame([(None, g[1], 0) for g in good], SCHEMA)).collect()
    assert len(none) == 120 and {r.vec_id for r in none} == {None}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)], [(1, [0.5, 0.25], 0)], [(1, [0.5, 0.25], 0)] * 3):
        assert w.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_direction_without_variance(spark):
    rows = [(i, [float(i), 1.0, float(-i)], 0) for i in range(20)]
    got = w.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20 and abs(got[0].explained - 1) < 1e-9


def test_large_deviation_is_exact(spark):
    rows = [(i, [1e9 * (i % 3), -2e9 * (i % 5)], 0) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    x, n, sums, _ = plain([r[:2] for r in rows])
    for r in w.whitened(df).collect():
        assert int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))


def test_clashing_columns(spark):
    rows = [(i, [float(i), float(i * i % 7)], 0, 1, 2, 3) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA + ", component int, n long, vector int")
    assert w.embedding_whitening(df).count() == 18


Q = np.linalg.qr(np.random.default_rng(1).normal(size=(48, 48)))[0]
SPECTRA = {
    "repeated": [3.0] * 16 + [2.0] * 16 + [0.0] * 16,
    "clusters": [*(1 + 1e-9 * np.arange(24)), *(2 + 1e-12 * np.arange(24))],
    "one cluster": list(1 + 1e-7 * np.arange(48)),
    "graded": list(10.0 ** -np.linspace(0, 15, 48)),
    "equal": [1.0] * 48,
    "zero": [0.0] * 48,
}


@pytest.mark.parametrize("name", SPECTRA)
def test_hard_spectra(name):
    a = Q @ np.diag(SPECTRA[name]) @ Q.T
    a = (a + a.T) / 2
    values, x = w.eigenpairs(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.all(np.diff(values) <= 0)
    assert np.abs(x.T @ x - np.eye(48)).max() < 5e-15
    assert np.abs(a @ x - x * values).max() < 1e-14 * scale
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 2e-14 * scale


def test_correction_beats_single_precision():
    rng = np.random.default_rng(9)
    b = rng.normal(size=(400, 40))
    a = b.T @ b / 400
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    _, x = w.eigenpairs(a)
    exact = np.linalg.eigh(a)[1][:, ::-1]
    off = lambda y: np.abs(np.abs((y * exact).sum(axis=0)) - 1).max()
    residual = lambda y: np.abs(a @ y - y * ((a @ y) * y).sum(axis=0)).max()
    assert off(x) < 1e-13 and residual(x) < 1e-4 * residual(single[:, ::-1])
