import math

import numpy as np
import pytest

from llm_cases import llm  # noqa: F401
from motorlake.llm import whitening

VECTORS = "vec_id bigint, embedding array<float>"


def brute(rows, components=8):
    """(vec_id, component) -> all other columns, by an eigendecomposition of the whole covariance."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good], dtype=object)
    n = len(good)
    sums = x.sum(0)
    exact = n * x - sums
    centred = exact.astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = centred @ vectors / np.sqrt(values)
    deviation = (exact * exact).sum(1)
    trace = (centred ** 2).sum() / n
    return {(i, k + 1): (n, int(d), w[k], values[k] / trace) for (i, _), d, w in zip(good, deviation, white) for k in range(len(values))}


def check(llm, rows, components=8):
    want = brute(rows, components)
    got = whitening.whiten(llm.createDataFrame(rows, VECTORS), components).collect()
    assert len(got) == len(want)
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error < 1e-9
        s = sign.setdefault(r.component, math.copysign(1, r.whitened * white))
        assert s * r.whitened == pytest.approx(white, abs=1e-8)


def test_whitening_against_brute_force(llm):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12)) * np.linspace(1, 0.1, 12)
    rows = [(i, (rng.normal(size=12) @ mix).tolist()) for i in range(200)]
    rows += [(900, None), (901, [None] * 12), (902, [math.nan] * 12), (903, [math.inf] * 12), (904, [0.0] * 12), (905, [])]
    check(llm, rows)
    check(llm, rows[:3] + rows[-6:], 2)
    check(llm, [(i, v[:3] if v else v) for i, v in rows], 8)  # fewer dimensions than components


def test_many_dimensions_with_close_eigenvalues(llm):
    rng = np.random.default_rng(2)
    check(llm, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 60)))], 3)


def test_odd_rows(llm):
    empty = llm.createDataFrame([], VECTORS)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(empty).columns == names and whitening.whiten(empty).count() == 0
    assert whitening.whiten(llm.createDataFrame([(1, [0.5, 1.0])], VECTORS)).count() == 0  # no variance
    assert whitening.whiten(llm.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], VECTORS)).count() == 0
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, 3.0]), (2, [7.0]), (3, [1e30, 0.0])]
    df = llm.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS x", "'y' AS n", "'z' AS whitened")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id or 0) for r in got) == [0, 1, 1] and {r.n for r in got} == {3}  # rank 1; short and huge ones out


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 50, 0], [0, 1 << 50], [5, 7]])
    centre = whitening.Centre(3, x.sum(0))
    want = [sum((3 * int(v) - int(s)) ** 2 for v, s in zip(r, x.sum(0))) for r in x]
    assert [int(d.as_py()) for d in centre.deviations(x)] == want
    big = whitening.Centre(10**6, np.array([10**11, 0]))
    assert int(big.deviations(np.array([[99_000, 3]]))[0].as_py()) == (10**6 * 99_000 - 10**11) ** 2 + (3 * 10**6) ** 2


@pytest.mark.parametrize("case", ["equal", "falling", "one", "zero"])
def test_eigenpairs(case):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    values = {"equal": np.r_[np.ones(6), np.full(24, 0.5)], "falling": 10.0 ** -np.arange(30), "one": np.r_[2.0, np.zeros(29)],
              "zero": np.zeros(30)}[case]
    matrix = basis * values @ basis.T
    e, q = whitening.leading_eigenpairs(lambda b: matrix @ b, 30, 8)
    want = values[:8][values[:8] > 1e-10 * values.max()]
    assert e == pytest.approx(want, rel=1e-4) and np.abs(q.T @ q - np.eye(len(e))).max(initial=0) < 1e-12
    assert np.linalg.norm(matrix @ q - q * e, axis=0).max(initial=0) <= 2e-14 * values.max()
