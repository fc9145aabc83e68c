"""Embedding whitening by Jacobi-Davidson.

The covariance is never formed: a pass over the rows returns its product with a few vectors, from centred rows, each
task adding up its own share. On the driver lives a small search space. Rayleigh-Ritz in it gives approximate
eigenpairs; each one's correction solves the equation (I - BB')(A - theta I)(I - BB') t = -r, where B spans the pairs
held and sought, by MINRES. All equations advance together, so that one pass serves one step of each. Pairs are locked
once their residual has reached double precision, and the search goes on beside them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import staged

#: Entries are floor(SCALE * c) + OFFSET; rows with an entry of 2**LARGEST or more don't fit and are left out.
SCALE, OFFSET, LARGEST = 1024, 100_000, 40
#: A residual counts as zero at this share of the largest eigenvalue.
TOLERANCE = 64 * np.finfo(float).eps
#: Components under this share of the largest eigenvalue count as without variance: rounding would make up much of them.
LEAST_SHARE = 1e-10
MOST_ROUNDS = 200


# ------------------------------------------------------------------ eigenpairs

def _orthogonal(new: np.ndarray, *held: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the spaces ``held``; what is in them but for rounding adds nothing."""
    for _ in range(3):
        before = np.linalg.norm(new, axis=0)
        for h in held:
            new = new - h @ (h.T @ new)
        norm = np.linalg.norm(new, axis=0)
        adds = norm > 1e-10 * before
        if not adds.any():
            return new[:, :0]
        left, size, _ = np.linalg.svd(new[:, adds] / norm[adds], full_matrices=False)
        new = left[:, size > 1e-8]
    return new


def _minres(product: Callable[[np.ndarray], np.ndarray], shift: np.ndarray, basis: np.ndarray, right: np.ndarray,
            least: float, steps: int) -> np.ndarray:
    """Solves (I - BB')(A - shift)(I - BB') t = right for every column, until its residual is ``least`` of the first."""
    project = lambda x: x - basis @ (basis.T @ x)
    right = project(right)
    beta = np.maximum(np.linalg.norm(right, axis=0), 1e-300)
    first = beta.copy()
    x, v, before = np.zeros_like(right), right / beta, np.zeros_like(right)
    w, w_before = np.zeros_like(right), np.zeros_like(right)
    eta, c, c_before = beta.copy(), np.ones_like(beta), np.ones_like(beta)
    s, s_before = np.zeros_like(beta), np.zeros_like(beta)
    on = np.arange(len(beta))
    for _ in range(steps):
        image = project(product(v[:, on]) - shift[on] * v[:, on])
        alpha = (v[:, on] * image).sum(0)
        follow = image - alpha * v[:, on] - beta[on] * before[:, on]
        size = np.linalg.norm(follow, axis=0)
        delta = c[on] * alpha - c_before[on] * s[on] * beta[on]
        length = np.maximum(np.hypot(delta, size), 1e-300)
        above, twice = s[on] * alpha + c_before[on] * c[on] * beta[on], s_before[on] * beta[on]
        turn = (v[:, on] - twice * w_before[:, on] - above * w[:, on]) / length
        c_before[on], c[on] = c[on], delta / length
        s_before[on], s[on] = s[on], size / length
        w_before[:, on], w[:, on] = w[:, on], turn
        x[:, on] += c[on] * eta[on] * turn
        eta[on] *= -s[on]
        before[:, on], beta[on] = v[:, on], size
        v[:, on] = follow / np.maximum(size, 1e-300)
        on = on[(np.abs(eta[on]) > least * first[on]) & (size > 1e-14 * np.abs(shift[on]).max())]
        if not len(on):
            break
    return project(x)


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 5,
                       rounds: int = MOST_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (falling, those over ``LEAST_SHARE``) and unit eigenvectors of a symmetric, nonnegative
    matrix that is known by its ``product`` with a block of vectors.

    Every pair's residual is at most ``TOLERANCE`` of the largest eigenvalue; if that is not reached, it fails.
    """
    wanted = min(wanted, dim)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    if not wanted:
        return values, locked

    def krylov(depth: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Random vectors and their images, beside what is locked."""
        space, images = np.zeros((dim, 0)), np.zeros((dim, 0))
        new = _orthogonal(rng.normal(size=(dim, min(width, dim - locked.shape[1]))), locked)
        for _ in range(depth):
            if not new.shape[1]:
                break
            image = product(new)
            space, images = np.hstack([space, new]), np.hstack([images, image])
            new = _orthogonal(image, locked, space)
        return space, images

    space, images = krylov(2, wanted + 2)
    for turn in range(rounds):
        small = space.T @ images
        theta, turned = np.linalg.eigh((small + small.T) / 2)
        theta, turned = theta[::-1], turned[:, ::-1]
        ritz, image = space @ turned, images @ turned
        top = max([*theta[:1], *values[:1], 0.0])
        sought = min(wanted - len(values), len(theta))
        residual = image[:, :sought] - theta[:sought] * ritz[:, :sought]
        residual -= locked @ (locked.T @ residual)
        far = np.linalg.norm(residual, axis=0) > TOLERANCE * top
        done = int(np.argmax(far)) if far.any() else sought
        if done:
            locked, values = np.hstack([locked, ritz[:, :done]]), np.append(values, theta[:done])
            space, images, theta = ritz[:, done:], image[:, done:], theta[done:]
            ritz, image, residual, far = ritz[:, done:], image[:, done:], residual[:, done:], far[done:]
            sought -= done
        if not sought:
            # Nothing larger may be left beside what is locked: a fresh look, and on with it if there is.
            fresh, fresh_images = krylov(3, 4)
            more = np.linalg.eigvalsh(fresh.T @ fresh_images).max(initial=-np.inf)
            if more <= values.min(initial=np.inf) + TOLERANCE * top:
                break
            order = np.argsort(-values)[:-1]
            locked, values = locked[:, order], values[order]
            space = _orthogonal(np.hstack([fresh, space[:, :wanted]]), locked)
            images = product(space)
            continue
        basis = np.hstack([locked, ritz[:, :sought]])
        steps = _minres(product, theta[:sought][far], basis, -residual[:, far], max(0.5 ** (turn + 2), 1e-4), 24)
        if space.shape[1] > 4 * wanted + 8:  # thick restart with the best part of the space
            space, images = ritz[:, :2 * wanted], image[:, :2 * wanted]
        new = _orthogonal(steps, locked, space)
        if not new.shape[1]:
            new = _orthogonal(rng.normal(size=(dim, sought)), locked, space)
            if not new.shape[1]:  # the space is whole; images are made anew to shed their rounding
                images = product(space)
                continue
        space, images = np.hstack([space, new]), np.hstack([images, product(new)])
    else:
        raise RuntimeError(f"residuals did not reach {TOLERANCE:g} of the largest eigenvalue in {rounds} rounds")
    order = np.argsort(-values, kind="stable")[:wanted]
    order = order[values[order] > LEAST_SHARE * values.max(initial=0)]
    values, locked = values[order], locked[:, order]
    sign = np.sign(locked[np.abs(locked).argmax(0), np.arange(len(order))])
    return values, locked * sign


# ------------------------------------------------------------------ rows

def _matrix(column: pa.Array, dim: int, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def integer_rows(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows that take part as (vec_id, x), x being 64-bit integers in one binary, written once; and their dimension."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << LARGEST)))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & fits)
    sizes = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dim = sizes[0]["n"] if sizes else 1

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            x = np.floor(c * SCALE).astype("<i8") + OFFSET
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "x"])

    held = rows.where(F.size(v) == dim).select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), v.alias("v"))
    return staged(held.mapInArrow(whole, "vec_id bigint, x binary"), "whitening"), dim


@dataclass
class Centre:
    """n rows and their exact sums per dimension; rows are centred without rounding their integers."""

    n: int
    sums: np.ndarray

    def __post_init__(self) -> None:
        self.base = self.sums // max(self.n, 1)
        self.rest = self.sums - self.n * self.base  # from 0 to n - 1

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / max(self.n, 1)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S) squared, exact."""
        near = x - self.base
        reach = self.n * (float(np.abs(near).max(initial=0)) + 1)
        if reach * reach * x.shape[1] < 2.0 ** 62:
            d = self.n * near - self.rest
            return pa.array((d * d).sum(1)).cast(pa.decimal128(38, 0))
        d = self.n * near.astype(object) - self.rest.astype(object)
        return pa.array([Decimal(int(r)) for r in (d * d).sum(1)], pa.decimal128(38, 0))


def _summed(rows: DataFrame, height: int, width: int, kind: str, add: Callable[[np.ndarray, np.ndarray], None], dim: int) -> np.ndarray:
    """``add(total, x)`` over all rows: a height x width block leaves each task, and the blocks meet row by row."""
    dtype = np.int64 if kind == "bigint" else np.float64

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width), dtype)
        for b in batches:
            if b.num_rows:
                add(total, _matrix(b.column(0), dim))
        yield pa.RecordBatch.from_pydict({"j": np.arange(height)} | {f"c{k}": total[:, k] for k in range(width)})

    ddl = ", ".join(["j bigint", *[f"c{k} {kind}" for k in range(width)]])
    sums = rows.select("x").mapInArrow(share, ddl).groupBy("j").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(width)])
    out = np.zeros((height, width), dtype)
    for r in sums.collect():
        out[r["j"]] = [r[f"c{k}"] for k in range(width)]
    return out


@dataclass
class Whitening:
    """Components (columns of ``vectors``) with eigenvalues, of the covariance of the centred integer rows."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist()

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, dim: int, components: int = 8) -> Whitening:
    """Whitening of the rows of ``integer_rows``; fewer components where the covariance has a smaller rank."""
    def add_sums(total: np.ndarray, x: np.ndarray) -> None:
        total[:, 0] += x.sum(0)

    n = rows.count()
    centre = Centre(n, _summed(rows, dim, 1, "bigint", add_sums, dim)[:, 0])

    def add_squares(total: np.ndarray, x: np.ndarray) -> None:
        total[:, 0] += (centre.centred(x) ** 2).sum(0)

    trace = float(_summed(rows, dim, 1, "double", add_squares, dim).sum()) / max(n, 1)

    def product(block: np.ndarray) -> np.ndarray:
        def add(total: np.ndarray, x: np.ndarray) -> None:
            c = centre.centred(x)
            total += c.T @ (c @ block)

        return _summed(rows, dim, block.shape[1], "double", add, dim) / n

    if trace == 0:
        return Whitening(centre, np.zeros(0), np.zeros((dim, 0)), trace)
    return Whitening(centre, *leading_eigenpairs(product, dim, components), trace)


def identity_error(rows: DataFrame, dim: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity; 0 without components."""
    m, n = len(model.values), model.centre.n
    if not m:
        return 0.0

    def add_sums(total: np.ndarray, x: np.ndarray) -> None:
        total[:, 0] += model.whitened(x).sum(0)

    mean = _summed(rows, m, 1, "double", add_sums, dim)[:, 0] / n

    def add(total: np.ndarray, x: np.ndarray) -> None:
        c = model.whitened(x) - mean
        total += c.T @ c

    return float(np.abs(_summed(rows, m, m, "double", add, dim) / n - np.eye(m)).max())


def transform(rows: DataFrame, dim: int, model: Whitening) -> DataFrame:
    """``vec_id, deviation, whitened``: per row the exact sum of (n x - S)^2, and its place on every component."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), dim)
            y = model.whitened(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), model.centre.deviations(x), lists], names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(apply, "vec_id bigint, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row per vector and component.

    Entries c become integers x = floor(1024 c) + 100000. Vectors that are null, empty, or hold a null, non-finite or
    too large entry (2**40 and more) are left out, and so are those of another dimension than the most frequent one (of
    equally frequent ones the larger). The others are the fit list of n rows with sums S; repeated rows and null keys
    count one by one. Components are unit eigenvectors of the covariance of x (divisor n), from 1 by falling
    eigenvalue e, the entry of largest size positive. ``deviation``: the sum of (n x - S)^2, exact; ``whitened``:
    (x - S/n) on the component over sqrt(e); ``explained``: e over the trace. Components without variance have no rows:
    equal rows, a single row or an empty table give an empty result. Other columns are ignored.
    """
    rows, dim = integer_rows(vectors, key, vector)
    model = fit(rows, dim, components)
    error = identity_error(rows, dim, model)
    placed = transform(rows, dim, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.get(F.array(*map(F.lit, model.explained)) if model.explained else F.array().cast("array<double>"), F.col("at"))
    return placed.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n).cast("bigint").alias("n"), "deviation",
        "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
