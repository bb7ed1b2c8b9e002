"""Whitening against a plain eigendecomposition in numpy."""

import math

import numpy as np
import pytest

from castledger.llm import whitening


def vectors(seed, n, dim, scale=3.0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dim)) * np.linspace(1, scale, dim)).astype(np.float32)


def frame(spark, rows, partitions=3):
    """With columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows],
                                 "vec_id long, embedding array<float>, dim int, x string, n int").repartition(partitions)


def expected(rows):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, own = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    values, own = values[order], own[:, order]
    return x, n, sums, values, own, np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("n,dim", [(300, 24), (40, 5), (9, 64), (3, 1)])
def test_matches_numpy(spark, n, dim):
    data = [(i, v.tolist()) for i, v in enumerate(vectors(n, n, dim))]
    data += [(1000 + i, data[0][1]) for i in range(n // 2)] + [(1, data[1][1]), (None, data[2][1])]  # repeats
    x, size, sums, values, own, trace = expected(data)
    kept = values > 1e-9 * values[0]
    got = whitening.whiten(frame(spark, data)).toPandas()
    assert len(got) == len(data) * kept.sum() and set(got.n) == {size}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), values[kept] / trace, rtol=1e-9)
    by_id = {i: row for (i, _), row in zip(data, x)}
    sign = {}
    for (vec, component), part in got.dropna(subset=["vec_id"]).groupby(["vec_id", "component"]):
        row = by_id[int(vec)]
        assert set(part.deviation) == {int(sum(int(d) ** 2 for d in size * row - sums))}
        want = (row - sums / size) @ own[:, component - 1] / math.sqrt(values[component - 1])
        for value in part.whitened:
            assert abs(abs(value) - abs(want)) < 1e-6
            if abs(want) > 1e-3:  # either sign, the same for all rows
                assert sign.setdefault(component, np.sign(value / want)) == np.sign(value / want)
    assert len(sign) == kept.sum()


def test_rows_that_are_dropped(spark):
    good = [(i, v.tolist()) for i, v in enumerate(vectors(2, 30, 4))]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [float("nan"), 1.0, 1.0, 1.0]),
           (104, [float("inf"), 1.0, 1.0, 1.0]), (105, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, good + bad))
    assert {r.vec_id for r in got.select("vec_id").collect()} == set(range(30))


@pytest.mark.parametrize("data", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]],
                         ids=["empty", "null", "one", "equal"])
def test_without_variance_there_is_nothing(spark, data):
    got = whitening.whiten(frame(spark, data))
    assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def symmetric(values, seed=4):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]
    m = (q * np.asarray(values, float)) @ q.T
    return (m + m.T) / 2


SPECTRA = {"random": 60 + 15 * np.random.default_rng(1).random(64), "ties": [5.0] * 10 + [4.0] * 12 + [1.0] * 10,
           "steep": np.geomspace(1e8, 1e-3, 40), "low rank": [3.0, 2.0, 1.0] + [0.0] * 20, "one": [2.0],
           "close pair": [9.0, 9.0 - 1e-9, 5.0, 1.0], "zero": [0.0, 0.0]}


@pytest.mark.parametrize("name", SPECTRA)
def test_intervals_and_contours_find_the_largest(name):
    matrix = symmetric(SPECTRA[name])
    cut = whitening.intervals(matrix, 16)
    found = [whitening.feast(matrix, *c) for c in cut]
    values = np.concatenate([f[0] for f in found] or [np.empty(0)])
    rows = np.concatenate([f[1] for f in found] or [np.empty((0, len(matrix)))])
    true = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    true = true[true > 1e-11 * max(true[0], 1e-300)]
    wanted = min(16, len(true))
    assert len(values) >= wanted
    assert np.allclose(np.sort(values)[::-1][:wanted], true[:wanted], rtol=1e-10, atol=1e-9 * max(true, default=1))
    assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-6 if name == "close pair" else 1e-8)


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_counts(name):
    matrix, values = symmetric(SPECTRA[name]), np.asarray(SPECTRA[name])
    for at in (-1.0, 0.5, 4.5, 61.7, 68.0, 1e4):
        assert whitening.eigenvalues_above(matrix, at) == int((values > at).sum())


def test_a_deviation_beyond_64_bits_is_null():
    assert whitening._deviation(np.array([3, -4])) == 25
    assert whitening._deviation(np.array([2**32, 2**32])) is None
    assert whitening._deviation(np.array([2**31 - 1, 1])) == (2**31 - 1) ** 2 + 1
