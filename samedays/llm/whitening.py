"""Whitening of embeddings by the leading eigenvectors of their covariance, found by a block Jacobi-Davidson method.

The covariance is never formed. It is only met in products with a block of a few vectors: every task centres its rows,
multiplies them by the block and back, and sends one sum of the block's size. Sums meet in `SLOTS` groups before the
driver adds them, so the driver gets the same number of small blocks from any number of tasks.

1. Entries become integers; their count and sums are exact, so every row is centred without rounding to speak of.
2. Rayleigh-Ritz on a subspace of bounded size gives approximate pairs and their residuals. Pairs whose residual is
   at double precision are locked, in falling order, and leave the subspace.
3. For the others the projected correction equation (I - PP')(A - theta I)(I - PP') t = -r, P being the locked and the
   wanted directions, is solved by a few steps of MINRES. All right-hand sides take their steps together, one
   distributed product per step. The corrections widen the subspace; when it is full it restarts from its best half.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are left out, and so are empty vectors
and those of another length than most (of two lengths as frequent, the longer one stays). Null and repeated ids and
repeated vectors count row by row. Directions without variance (below `RANK` of the largest) cannot be whitened and are
no components; without any, as for a table that is empty or holds one vector only, there are no rows. Entries whose
integers do not fit 53 bits, and deviations that do not fit 64, stop the job. Other columns have no part in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import Scratch

#: An entry c becomes floor(SCALE c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: MINRES steps for a correction, and the subspace's greatest size in wanted pairs.
INNER, SPACE = 5, 4
#: Groups in which the sums of the tasks meet.
SLOTS = 16
#: Least variance of a component, of the largest one's.
RANK = 1e-10
#: Rounds after which the residuals count as stuck, and the greatest residual with which they may be.
STUCK, LEAST = 4, 1e-10
ROUNDS = 300

Block = np.ndarray


def _minres(apply: Callable[[Block], Block], right: Block, steps: int) -> Block:
    """Approximate solutions of `apply(x) = right` for every column, all columns in step; `apply` is symmetric."""
    beta = np.linalg.norm(right, axis=0)
    running = beta > 0
    safe = np.where(running, beta, 1)
    found, v, v_old = np.zeros_like(right), right / safe, np.zeros_like(right)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    eta, scale = beta.copy(), beta.copy()
    cos, cos_old = np.ones_like(beta), np.ones_like(beta)
    sin, sin_old = np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        if not running.any():
            break
        image = apply(v)
        alpha = (v * image).sum(axis=0)
        image -= alpha * v + beta * v_old
        beta_next = np.linalg.norm(image, axis=0)
        delta = cos * alpha - cos_old * sin * beta
        rho_2, rho_3 = sin * alpha + cos_old * cos * beta, sin_old * beta
        rho = np.hypot(delta, beta_next)
        running &= rho > 0
        rho = np.where(running, rho, 1)
        w, w_old = (v - rho_3 * w_old - rho_2 * w) / rho, w
        cos_old, sin_old = cos, sin
        cos, sin = delta / rho, beta_next / rho
        found += np.where(running, cos * eta, 0) * w
        eta = -sin * eta
        running &= (beta_next > 0) & (np.abs(eta) > np.finfo(float).eps * scale)
        v, v_old, beta = image / np.where(beta_next > 0, beta_next, 1), v, beta_next
    return found


def _widened(basis: Block, block: Block) -> Block:
    """Orthonormal directions of a block beyond those of a basis; directions that hold nothing new are left out."""
    for _ in range(3):
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        block = block - basis @ (basis.T @ block)
        block = block[:, np.linalg.norm(block, axis=0) > 1e-10]
        if block.shape[1]:
            left, singular, _ = np.linalg.svd(block, full_matrices=False)
            block = left[:, singular > 1e-10 * singular[0]]
    return block[:, : basis.shape[0] - basis.shape[1]]


def jacobi_davidson(product: Callable[[Block], Block], dimension: int, wanted: int, inner: int = INNER) -> tuple[Block, Block]:
    """(values, vectors) of the largest eigenvalues, falling, of a symmetric matrix known by its products only."""
    random = np.random.default_rng(13)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    basis = _widened(locked, random.standard_normal((dimension, min(dimension, wanted + 4))))
    image = product(basis)
    best, stuck = np.inf, 0
    for _ in range(ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        left = min(wanted - len(values), len(theta))
        ritz, mapped = basis @ turn[:, :left], image @ turn[:, :left]
        residual = mapped - ritz * theta[:left]
        norms = np.linalg.norm(residual, axis=0)
        largest = max(np.max(np.abs(theta)), np.max(np.abs(values), initial=0))
        precise = norms <= 4 * dimension * np.finfo(float).eps * largest
        whole = locked.shape[1] + basis.shape[1] == dimension
        # rounding in the products can keep residuals a little above the unit roundoff
        stuck = 0 if norms.max() < best / 2 else stuck + 1
        best = min(best, norms.max())
        if (whole or stuck >= STUCK) and norms.max() <= LEAST * largest:
            precise[:] = True
        ready = left if precise.all() else int(np.argmin(precise))
        if ready:
            locked, values = np.hstack([locked, ritz[:, :ready]]), np.append(values, theta[:ready])
            basis, image = basis @ turn[:, ready:], image @ turn[:, ready:]
            theta, turn = theta[ready:], np.eye(basis.shape[1])
            best, stuck = np.inf, 0
        if len(values) == wanted or whole and ready:
            if len(values) >= wanted or not basis.shape[1]:
                return values, locked
        if basis.shape[1] > SPACE * wanted - left:
            keep = 2 * wanted
            basis, image = basis @ turn[:, :keep], image @ turn[:, :keep]
        open_pairs = slice(ready, left)
        away = np.hstack([locked, ritz[:, open_pairs]])
        shift = theta[: left - ready]

        def projected(block: Block, away: Block = away, shift: Block = shift) -> Block:
            inside = block - away @ (away.T @ block)
            outside = product(inside) - inside * shift
            return outside - away @ (away.T @ outside)

        if left > ready and not whole:
            right = -residual[:, open_pairs]
            corrections = _minres(projected, right - away @ (away.T @ right), inner)
        else:
            corrections = np.zeros((dimension, 0))
        fresh = _widened(np.hstack([locked, basis]), corrections)
        if not fresh.shape[1]:
            # nothing new: another random direction, or fresh images where the subspace is the whole space
            fresh = _widened(np.hstack([locked, basis]), random.standard_normal((dimension, 1)))
            if not fresh.shape[1]:
                image = product(basis)
                continue
        basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError(f"residuals of {wanted - len(values)} eigenvectors are still at {best:.1e}")


def _matrix(batch: pa.RecordBatch, dimension: int) -> Block:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _summed(rows: DataFrame, dimension: int, make: Callable[[Block], Block], kind: type = np.float64) -> Block:
    """The sum over all rows of what `make` gives for a matrix of some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = make(_matrix(batch, dimension))
                total = made if total is None else total + made
        if total is not None:
            slot = TaskContext.get().partitionId() % SLOTS
            yield pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(part, kind) for part in parts["part"]], axis=0)
        return pd.DataFrame({"part": [total.tobytes()]})

    parts = rows.select("x").mapInArrow(run, "slot int, part binary").groupBy("slot").applyInPandas(added, "part binary")
    return np.sum([np.frombuffer(row.part, kind) for row in parts.collect()], axis=0)


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector has entries, all of them finite."""
    entries = F.col(vector)
    bound = float((1 << 53) - 2 * SHIFT) / SCALE

    def usable(entry: Column) -> Column:
        return entry.isNotNull() & ~F.isnan(entry.cast("double")) & (F.abs(entry.cast("double")) != float("inf"))

    def integer(entry: Column) -> Column:
        value = entry.cast("double")
        too_large = F.raise_error(F.lit("an entry of a vector does not fit 53 bits as an integer")).cast("long")
        return F.when(F.abs(value) > bound, too_large).otherwise(F.floor(value * float(SCALE)) + F.lit(SHIFT))

    finite = table.where(F.coalesce(F.size(entries) > 0, F.lit(False)) & F.coalesce(F.forall(entries, usable), F.lit(False)))
    return finite.select(F.col(vec_id).alias("vec_id"), F.transform(entries, integer).alias("x"))


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component."""
    scratch = Scratch(table.sparkSession, "whitening")
    usable = scratch.keep(integer_vectors(table, vec_id, vector))
    id_type = usable.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = usable.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return table.sparkSession.createDataFrame([], schema)
    dimension, n = most["length"], most["n"]
    rows = usable.where(F.size("x") == dimension)

    sums = _summed(rows, dimension, lambda x: x.sum(axis=0), np.int64)
    whole = sums // n
    rest = (sums - n * whole) / n

    def centred(x: Block) -> Block:
        return (x - whole).astype(np.float64) - rest

    trace = float(_summed(rows, dimension, lambda x: (centred(x) ** 2).sum(keepdims=True)).sum()) / n
    if not trace:
        return table.sparkSession.createDataFrame([], schema)

    def product(block: Block) -> Block:
        def made(x: Block) -> Block:
            c = centred(x)
            return c.T @ (c @ block)

        return _summed(rows, dimension, made).reshape(dimension, -1) / n

    values, vectors = jacobi_davidson(product, dimension, min(components, dimension))
    kept = values > RANK * values[0]
    values, vectors = values[kept], vectors[:, kept]
    many = len(values)

    def whitened(x: Block) -> Block:
        return centred(x) @ vectors / np.sqrt(values)

    mean = _summed(rows, dimension, lambda x: whitened(x).sum(axis=0)) / n

    def spread(x: Block) -> Block:
        w = whitened(x) - mean
        return w.T @ w

    covariance = _summed(rows, dimension, spread).reshape(many, many) / n
    error = float(np.abs(covariance - np.eye(many)).max())
    explained = values / trace

    def deviations(x: Block) -> list[int]:
        # exact: in 64 bits where all steps surely fit, in Python's integers elsewhere
        widest = n * (int(np.abs(x - whole).max()) + 1)
        scaled = n * (x - whole) - (sums - n * whole) if widest < 2**31 else n * (x - whole).astype(object) - (sums - n * whole).astype(object)
        if widest**2 * dimension >= 2**63:
            scaled = scaled.astype(object)
        return (scaled * scaled).sum(axis=1).tolist()

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, dimension)
            size = len(x) * many
            at = pa.array(np.repeat(np.arange(len(x)), many))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(at),
                    "component": pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(size, n, np.int64)),
                    "deviation": pa.array(deviations(x), pa.int64()).take(at),
                    "whitened": pa.array(whitened(x).ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(size, error)),
                }
            )

    return rows.select("vec_id", "x").mapInArrow(results, schema)
