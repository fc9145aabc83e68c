import numpy as np
import pytest

from llm_cases import llm  # noqa: F401
from motorlake.llm import curves


def brute(rows, k=10, every=100):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dims = [len(v) for _, v in ok]
    dim = max(set(dims), key=lambda d: (dims.count(d), d))
    ok = [(i, v) for i, v in ok if len(v) == dim]
    out = set()
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = {}
        for j, v in ok:
            if j != q:
                d = min(float(curves.exact_distances(w, v[None])[0]) for i, w in ok if i == q)
                best[j] = min(d, best.get(j, np.inf))
        out |= {(q, r, j, d) for r, (d, j) in enumerate(sorted((d, j) for j, d in best.items())[:k], 1)}
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(llm, kind):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 12))
    x = np.concatenate([centres[rng.integers(5, size=500)] + 0.05 * rng.normal(size=(500, 12)), rng.normal(size=(300, 12))])
    x[100:160] = x[100]  # many equal vectors
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    rows += [(900, None), (1000, []), (1100, [0.0] * 12), (1200, [1.0] * 11 + [None]), (1300, [float("nan")] * 12),
             (1400, [float("inf")] * 12), (1500, [1.0, 2.0]), (None, [1.0] * 12), (5, rows[5][1]), (300, rows[300][1])]
    df = llm.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").selectExpr("*", "'x' AS score", "1 AS key")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in curves.nearest(df, window=16, curves=2).collect()}
    assert got == brute(rows)


def test_few_and_no_rows(llm):
    schema = "vec_id bigint, embedding array<float>"
    few = llm.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.5, 0.5])], schema)
    assert [(r.query_id, r.vec_id) for r in curves.nearest(few).orderBy("rank").collect()] == [(0, 2), (0, 1)]
    assert curves.nearest(llm.createDataFrame([], schema)).count() == 0
    assert curves.nearest(llm.createDataFrame([(0, [1.0])], schema)).count() == 0


def test_hilbert_neighbours_touch():
    points = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), -1).reshape(-1, 3)
    cells = np.zeros((len(points), curves.AXES), int)
    cells[:, :3] = points
    keys = curves.hilbert_keys(cells)
    assert len(set(keys.tolist())) == len(keys) and (keys >= 0).all()
