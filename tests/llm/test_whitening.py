"""Whitening against numpy's eigendecomposition of the same covariance."""

import math

import numpy as np
import pytest

from figloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def whole(rows):
    return [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]


def brute(rows, components=16):
    """n, exact deviations by id, eigenvalues, components and trace over the different vectors."""
    x = whole(rows)
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=object)
    n, total = len(fit), fit.sum(0)
    dev = {i: int(sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True))) for i, v in x}
    off = (fit * n - total).astype(float) / n
    v = off.T @ off / n
    e, q = np.linalg.eigh(v)
    return n, total, dev, e[::-1][:components], q[:, ::-1][:, :components], np.trace(v)


def check(got, rows, components=16):
    n, total, dev, e, q, trace = brute(rows, components)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    x = dict(whole(rows))
    for c, told in by.items():
        assert len(told) == len(rows)
        want = {i: float(((np.array(v, dtype=object) * n - total).astype(float) / n) @ q[:, c - 1] / math.sqrt(e[c - 1])) for i, v in x.items()}
        sign = np.sign(sum(r["whitened"] * want[r["vec_id"]] for r in told))
        for r in told:
            assert r["n"] == n and r["deviation"] == dev[r["vec_id"]]
            assert r["whitened"] == pytest.approx(sign * want[r["vec_id"]], abs=1e-8)
            assert r["explained"] == pytest.approx(e[c - 1] / trace, rel=1e-9) and r["identity_error"] < 1e-10 and r["drift"] < 1e-10
    return sorted(by)


def test_against_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 20)) * np.linspace(0.2, 3, 20)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(1000 + i, [float(c) for c in base[7]]) for i in range(150)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as component", "'x' as n").repartition(7)).collect()
    assert check(got, rows) == list(range(1, 17))


def test_rows_that_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), float(i % 5), 0.25]) for i in range(15)]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [nan, 1.0, 1.0]), (53, [1.0, -inf, 1.0]), (54, []), (55, [1.0]), (56, [1.0, 2.0, 3.0, 4.0])]
    got = whitening.whiten(spark.createDataFrame(good + bad, SCHEMA)).collect()
    assert check(got, good) == [1, 2]  # the third entry never varies
    again = whitening.whiten(spark.createDataFrame([*good, (None, good[3][1])], SCHEMA))
    assert again.where("vec_id is null").count() == 2


def test_nothing_to_tell(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.columns[:3] == ["vec_id", "component", "n"] and got.count() == 0


def test_equal_eigenvalues(spark):
    rows = [(2 * i + s, [(1 - 2 * s) * float(i == k) for k in range(5)]) for i in range(5) for s in (0, 1)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 50 and all(abs(r["explained"] - 0.2) < 1e-12 and r["identity_error"] < 1e-12 for r in got)


def test_deviations_stay_exact():
    big = np.array([[2**40, -(2**40)], [0, 5]])
    off = whitening._deviations(big, 2**30, np.array([7, 2**60]))
    assert off.dtype == object and off[0, 0] == 2**70 - 7
    assert whitening._squares(off).to_pylist() == [None, None]
    plain = whitening._deviations(np.array([[2**61, 1]]), 4, np.array([0, 0]))
    assert plain.dtype == object and plain[0, 0] == 2**63
    assert whitening._squares(whitening._deviations(np.array([[3, 4]]), 1, np.array([0, 0]))).to_pylist() == [25]


@pytest.mark.parametrize("d,n", [(1, 4), (2, 9), (12, 5), (12, 200)])
def test_incremental_spectrum_alone(d, n):
    rng = np.random.default_rng(d * n)
    x = rng.integers(-40, 40, (n, d))
    x[: n // 3] = x[0]
    parts = [whitening.Spectrum.empty(d) for _ in range(3)]
    for k, v in enumerate(x):
        parts[k % 3].add(v)
    one = parts[0]
    for other in parts[1:]:
        one.absorb(whitening.Spectrum.of(other.row()))
    off = x - x.mean(0)
    want = off.T @ off
    assert one.n == n and (one.total == x.sum(0)).all()
    assert np.allclose(one.vectors @ np.diag(one.values) @ one.vectors.T, want, atol=1e-10 * max(1, np.abs(want).max()))
    assert np.allclose(one.vectors.T @ one.vectors, np.eye(d), atol=1e-12)


def test_secular_roots_lie_between_the_poles():
    d, z = np.array([0.0, 1.0, 1.0 + 1e-9, 50.0]), np.array([1e-6, 0.5, 2.0, 1e-3])
    roots, den = whitening.secular_roots(d, z)
    assert (roots > d).all() and (roots[:-1] < d[1:]).all()
    assert np.allclose(np.sort(np.linalg.eigvalsh(np.diag(d) + np.outer(z, z))), roots, atol=1e-12)
    assert np.allclose(d[:, None] - roots[None, :], den, atol=1e-12)
