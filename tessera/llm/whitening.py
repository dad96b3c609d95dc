"""Whitening of embeddings: the leading eigenvectors of their covariance by Jacobi-Davidson.

The covariance is never formed. What the driver holds is a block of a few
vectors of the embeddings' dimension; a pass over all rows gives the
covariance times such a block (the rows are centred first, each task adds up
its own rows, and only one number for each entry of the block comes back).

Around these products runs a block Jacobi-Davidson: Rayleigh-Ritz in the
search space gives the best pairs; leading pairs whose residual is as small as
double precision allows are locked; for the others the correction equation,
projected off the locked and the present vectors, is solved by some steps of
MINRES (all in lockstep, a pass a step), and the corrections widen the space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.frames import fresh

COMPONENTS = 32
#: Contract of the integers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this can't be told as such integers (and their sums) in 64 bits.
LARGEST = float(1 << 40)
#: Pairs searched besides the wanted ones, MINRES steps a correction, size of the search space in blocks, rounds at most.
GUARD, INNER, SPACE, ROUNDS = 8, 4, 4, 200
#: Residual, and least eigenvalue that counts, relative to the largest eigenvalue.
RESIDUAL, LEAST = 1e-13, 1e-12
#: Rows that a task turns into numbers at once.
ROWS = 2048

Product = Callable[[np.ndarray], np.ndarray]


def _off(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The block without its part in an orthonormal basis (twice, for rounding)."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    return block


def orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of block add to basis; columns that add nothing but rounding go."""
    out = basis
    for column in block.T:
        size = np.linalg.norm(column)
        if size > 0:
            rest = _off(out, (column / size)[:, None])
            left = np.linalg.norm(rest)
            if left > 1e-10:
                rest = _off(out, rest / left)
                out = np.hstack([out, rest / np.linalg.norm(rest)])
    return out[:, basis.shape[1] :]


def minres(apply: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, by a number of MINRES steps in lockstep."""
    beta = np.linalg.norm(right, axis=0)
    eta, tiny = beta.copy(), 1e-14 * beta + 1e-300
    v0, v = np.zeros_like(right), right / np.where(beta > 0, beta, 1.0)
    w0, w1, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c0 = c1 = np.ones_like(beta)
    s0 = s1 = np.zeros_like(beta)
    live = beta > 0
    first = True
    for _ in range(steps):
        if not live.any():
            break
        av = apply(v)
        alpha = np.einsum("ij,ij->j", v, av)
        back = np.zeros_like(beta) if first else beta
        nxt = av - alpha * v - back * v0
        following = np.linalg.norm(nxt, axis=0)
        delta = c1 * alpha - c0 * s1 * back
        rho1, rho2, rho3 = np.hypot(delta, following), s1 * alpha + c0 * c1 * back, s0 * back
        live = live & (rho1 > tiny)
        safe = np.where(live, rho1, 1.0)
        w = (v - rho3 * w0 - rho2 * w1) / safe
        c, s = np.where(live, delta / safe, 1.0), np.where(live, following / safe, 0.0)
        x = x + np.where(live, c * eta, 0.0) * w
        eta = -s * eta
        live = live & (following > tiny)
        v0, v, beta = v, nxt / np.where(following > 0, following, 1.0), following
        w0, w1, c0, c1, s0, s1, first = w1, w, c1, c, s1, s, False
    return x


@dataclass
class Pairs:
    values: np.ndarray
    vectors: np.ndarray
    rounds: int = 0
    residual: float = 0.0


def jacobi_davidson(product: Product, dim: int, wanted: int, residual: float = RESIDUAL, inner: int = INNER, seed: int = 0) -> Pairs:
    """The largest eigenvalues (falling) and unit eigenvectors of a positive semi-definite matrix given by its products with blocks.

    Fewer than wanted come back if the rest is zero but for rounding.
    """
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dim)
    block = min(dim, wanted + GUARD)
    most = min(dim, SPACE * block)
    locked, values = np.empty((dim, 0)), np.empty(0)
    basis = orthonormal(rng.standard_normal((dim, block)), locked)
    image = product(basis)
    worst, top, at_rest = 0.0, 0.0, 0
    for turn in range(1, ROUNDS + 1):
        inner_matrix = basis.T @ image
        theta, turned = np.linalg.eigh((inner_matrix + inner_matrix.T) / 2)
        order = np.argsort(-theta, kind="stable")[:block]
        theta, vectors, image_of = theta[order], basis @ turned[:, order], image @ turned[:, order]
        top = max([top, *theta[:1], *values[:1]])
        rest = image_of - vectors * theta
        rest = _off(locked, rest) if locked.shape[1] else rest
        sizes = np.linalg.norm(rest, axis=0)
        need = min(wanted - len(values), len(theta))
        done = 0
        while done < need and sizes[done] <= residual * top:
            done += 1
        if done:
            worst = max(worst, float(sizes[:done].max() / top) if top else 0.0)
            locked = np.hstack([locked, vectors[:, :done]])
            values = np.append(values, theta[:done])
        if len(values) >= wanted or done == basis.shape[1] or top <= 0:
            break
        theta, vectors, image_of, rest, sizes = theta[done:], vectors[:, done:], image_of[:, done:], rest[:, done:], sizes[done:]
        todo = np.flatnonzero(sizes[: wanted - len(values)] > residual * top)
        if basis.shape[1] - done + len(todo) > most or done:
            # start again from the best, with products made anew
            basis = orthonormal(vectors, locked)
            image = product(basis)
        space = np.hstack([locked, vectors])
        if space.shape[1] < dim and len(todo):
            shift = theta[todo]

            def projected(v: np.ndarray) -> np.ndarray:
                v = _off(space, v)
                return _off(space, product(v) - v * shift)

            steps = minres(projected, -_off(space, rest[:, todo]), inner)
            added = orthonormal(_off(space, steps), np.hstack([locked, basis]))
        else:
            added = np.empty((dim, 0))
        if added.shape[1]:
            basis, image, at_rest = np.hstack([basis, added]), np.hstack([image, product(added)]), 0
        else:
            # the space can't grow: only rounding is left, which a fresh start from the pairs removes
            at_rest += 1
            if at_rest > 3:
                break
            basis = orthonormal(np.hstack([vectors, basis]), locked)
            image = product(basis)
    if len(values) < wanted and top > 0:
        missing = wanted - len(values)
        raise RuntimeError(f"{missing} eigenvectors without a residual of {residual} of the largest eigenvalue")
    order = np.argsort(-values, kind="stable")
    values, locked = values[order], locked[:, order]
    keep = values > LEAST * (values[0] if len(values) else 0.0)
    return Pairs(values[keep], locked[:, keep], turn, worst)


@dataclass
class Fit:
    """What whitening needs: rows n, sums S of the integers, their whole part of the mean, eigenpairs, trace."""

    dim: int
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int = 0
    residual: float = 0.0
    identity_error: float = 0.0

    @property
    def whole(self) -> np.ndarray:
        return self.sums // max(self.n, 1)

    @property
    def part(self) -> np.ndarray:
        return (self.sums - self.whole * self.n) / max(self.n, 1)


def _rows(batch: pa.RecordBatch, at: int, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their integers as a matrix) of the usable vectors of a batch, some rows at once."""
    column = batch.column(at)
    offsets = column.offsets.to_numpy().astype(np.int64)
    there = np.asarray(column.is_valid()) & (np.diff(offsets) == dim)
    rows = np.flatnonzero(there)
    flat = column.values.to_numpy(zero_copy_only=False)
    for a in range(0, len(rows), ROWS):
        some = rows[a : a + ROWS]
        c = flat[offsets[some][:, None] + np.arange(dim)].astype(np.float64)
        with np.errstate(invalid="ignore"):
            good = (np.abs(c) <= LARGEST).all(axis=1)  # also false for nulls, which are NaN here
        yield some[good], np.floor(SCALE * c[good]).astype(np.int64) + SHIFT


def _lengths(rows: DataFrame) -> list:
    fine = F.forall("v", lambda c: c.isNotNull() & F.coalesce(F.abs(c) <= LARGEST, F.lit(False)) & ~F.isnan(c))
    return rows.where("size(v) > 0").where(fine).groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()


def _cells(rows: DataFrame, kind: str, task: Callable[[Iterator[np.ndarray]], np.ndarray], dim: int, size: int) -> np.ndarray:
    """task's numbers for the rows of each partition, added up over all partitions: one row a number comes back."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = task(x for batch in batches for _, x in _rows(batch, 0, dim) if len(x))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(made.ravel())], names=["cell", "value"])

    added = rows.select("v").mapInArrow(work, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    for cell, value in added:
        out[cell] = value
    return out


def _summed(blocks: Iterator[np.ndarray], size: int) -> np.ndarray:
    """The sum of arrays with what rounding loses of each addition carried along."""
    total, lost = np.zeros(size), np.zeros(size)
    for block in blocks:
        block = block.ravel()
        s = total + block
        z = s - total
        lost += (total - (s - z)) + (block - z)
        total = s
    return total + lost


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, inner: int = INNER) -> Fit:
    """The whitening of all usable vectors: those without null, non-finite or huge entries and of the commonest length.

    Of lengths equally common the longest counts. With fewer than two rows, or
    no two different ones, there are no components.
    """
    rows = vectors.select(F.col(vector).cast("array<double>").alias("v"))
    found = _lengths(rows)
    if not found:
        return Fit(0, 0, np.empty(0, np.int64), np.empty(0), np.empty((0, 0)), 0.0)
    dim, n = found[0]
    sums = _cells(rows, "long", lambda xs: sum((x.sum(axis=0) for x in xs), np.zeros(dim, np.int64)), dim, dim)
    made = Fit(dim, n, sums, np.empty(0), np.empty((dim, 0)), 0.0)
    whole, part = made.whole, made.part

    def product(block: np.ndarray) -> np.ndarray:
        width = block.shape[1]

        def task(xs: Iterator[np.ndarray]) -> np.ndarray:
            centred = ((x - whole) - part for x in xs)
            return _summed((y.T @ (y @ block) for y in centred), dim * width)

        made.passes += 1
        return _cells(rows, "double", task, dim, dim * width).reshape(dim, width) / n

    squares = _cells(rows, "double", lambda xs: _summed((np.square((x - whole) - part).sum(axis=0) for x in xs), dim), dim, dim)
    made.trace = float(squares.sum() / n)
    if made.trace > 0:
        pairs = jacobi_davidson(product, dim, components, inner=inner)
        made.values, made.vectors, made.residual = pairs.values, pairs.vectors, pairs.residual
    k = len(made.values)
    if k:
        to = made.vectors / np.sqrt(made.values)

        def task(xs: Iterator[np.ndarray]) -> np.ndarray:
            whitened = (((x - whole) - part) @ to for x in xs)
            return _summed((z.T @ z for z in whitened), k * k)

        made.identity_error = float(np.abs(_cells(rows, "double", task, dim, k * k).reshape(k, k) / n - np.eye(k)).max())
    return made


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact sums over the dimensions of (n * x - S)**2."""
    most = float(np.abs(n * (x - sums // n).astype(np.float64)).max(initial=0) + n)
    if most * most * x.shape[1] < 2.0**62:
        return np.square(n * (x - sums // n) - sums % n).sum(axis=1).tolist()
    return [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]


def whiten(vectors: DataFrame, fitted: Fit, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable vector and component.

    deviation is exact, as a decimal without fraction (null beyond 38 digits).
    Repeated rows and ids each give their rows, null ids too; other columns
    aren't read.
    """
    ids = vectors.schema[vec_id].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    fresh(rows.select("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")
    dim, n, k, sums, whole, part = fitted.dim, fitted.n, len(fitted.values), fitted.sums, fitted.whole, fitted.part
    to = fitted.vectors / np.sqrt(fitted.values)
    explained = fitted.values / fitted.trace if k else np.empty(0)
    error = fitted.identity_error

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not k:
            return
        for batch in batches:
            for which, x in _rows(batch, 1, dim):
                m = len(which)
                if not m:
                    continue
                z = ((x - whole) - part) @ to
                arrays = [
                    batch.column(0).take(pa.array(np.repeat(which, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array([str(d) for d in deviations(x, n, sums)]).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    made = rows.mapInArrow(work, f"vec_id {ids}, component int, n long, deviation string, whitened double, explained double, identity_error double")
    return made.withColumn("deviation", F.expr("try_cast(deviation as decimal(38, 0))"))
