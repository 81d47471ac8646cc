"""Whitening of embeddings by Jacobi-Davidson on distributed centred products.

The covariance V of the fitted vectors is never formed: every product V @ P for a block P of a few vectors is one Spark job that
centres each vector, multiplies it with P and adds up partial sums by position. Eigenpairs come from Jacobi-Davidson: Rayleigh-Ritz
on a subspace, for each wanted pair that has not converged a correction equation (I - QQ')(V - theta)(I - QQ') t = -r, solved
by a few steps of MINRES (all pairs' equations in step, one product for all of them), the corrections join the subspace, converged pairs are locked
and the rest goes on until all wanted residuals reach double precision. A random block then tries whether a larger pair was missed.
The driver holds subspaces (dimensions x some 40) only, whatever the number of rows.

Entries c become integers floor(1024 c) + 100000, so that counts, sums and ``deviation`` are exact; a centred entry is the
exact integer distance from the mean's floor, less the mean's fraction.

Cases: rows whose vector is null, empty or holds null, NaN or infinite entries are left out, so are vectors with an entry of 2^51 or more (its
long does not fit) and vectors of another length than most have (ties: the longer); null and repeated ids are rows like others; components whose eigenvalue is 0 to
double precision can't be whitened and are left out, so equal vectors or a single one give no rows; a deviation that no long holds is null;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.session import materialise, ship

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries from this size on have no exact long.
TOO_LARGE = float(1 << 51)
#: Further pairs that the search carries along, so that the last wanted one is told from the next.
GUARDS = 2
#: MINRES steps of one correction equation at most, and the share of the residual at which it stops.
INNER, ENOUGH = 10, 0.02
#: Residuals, as a share of the largest eigenvalue, in units of rounding errors of a sum over the dimensions.
ROUNDING = 16
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Centre:
    """Number of vectors and, for each dimension, their mean as floor and remainder: sum = n * floor + remainder."""

    n: int
    floor: np.ndarray
    remainder: tuple[int, ...]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Centred doubles."""
        return (x - self.floor).astype(float) - np.array([r / self.n for r in self.remainder])

    def deviations(self, x: np.ndarray) -> list[str]:
        """Exact sums of (n x - sum)^2."""
        y = x - self.floor
        most = int(np.abs(y).max(initial=0)) * self.n + self.n
        if most * most * max(1, x.shape[1]) < 1 << 63:
            z = y * self.n - np.array(self.remainder, np.int64)
            return [str(v) for v in (z * z).sum(1).tolist()]
        return [str(sum((v * self.n - r) ** 2 for v, r in zip(row, self.remainder))) for row in y.tolist()]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: eigenvalues fall, vectors are columns; explained are shares of the trace."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors as rows of integers."""
    lists = batch.column("x")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def integers(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and x (array of longs) of the rows that remain, written once."""
    rows = rows.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fits = F.forall("v", lambda c: F.coalesce(F.abs(c) < TOO_LARGE, F.lit(False)))  # NaN is larger than any number
    x = F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT)
    rows = materialise(rows.where(F.coalesce((F.size("v") > 0) & fits, F.lit(False))).select(id_column, x.alias("x")), "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == sizes["d"]) if sizes else rows


def _sum_up(rows: DataFrame, work, kind: str) -> list:
    """Sums by position of the lists that ``work`` makes of partitions; as long as one list, whatever the number of partitions."""
    parts = rows.select("x").mapInArrow(work, f"part array<{kind}>").select(F.posexplode("part"))
    to = "decimal(38,0)" if kind == "string" else kind
    return [r[1] for r in sorted(parts.groupBy("pos").agg(F.sum(F.col("col").cast(to)).alias("total")).collect())]


def centre(rows: DataFrame) -> Centre | None:
    """Exact mean of all vectors; None where there are none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                n += len(x)
                high, low = (x >> 30).sum(0), (x & ((1 << 30) - 1)).sum(0)  # neither overflows
                sums = sums + high.astype(object) * (1 << 30) + low.astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([[str(n), *map(str, sums)]], pa.list_(pa.string()))], ["part"])

    found = [int(v) for v in _sum_up(rows, work, "string")]
    if not found:
        return None
    n, sums = found[0], found[1:]
    return Centre(n, np.array([s // n for s in sums], np.int64), tuple(s % n for s in sums))


def product(rows: DataFrame, mid: Centre, block: np.ndarray) -> np.ndarray:
    """Covariance times block, as one distributed sum."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                c = mid.of(matrix(batch))
                part = c.T @ (c @ block)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["part"])

    return np.array(_sum_up(rows, work, "double")).reshape(block.shape) / mid.n


def trace(rows: DataFrame, mid: Centre) -> float:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(float((mid.of(matrix(b)) ** 2).sum()) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([[total]], pa.list_(pa.float64()))], ["part"])

    return _sum_up(rows, work, "double")[0] / mid.n


def orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of t made orthonormal to each other and to the others; directions that vanish are left out."""
    kept: list[np.ndarray] = []
    before = np.concatenate([a for a in against if a.size] or [t[:, :0]], axis=1)
    for v in t.T:
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            for basis in (before, np.array(kept).T if kept else before[:, :0]):
                v = v - basis @ (basis.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-8:
                break
            v = v / size
        if size >= 1e-8:
            kept.append(v)
    return np.array(kept).T if kept else t[:, :0]


def corrections(times, values: np.ndarray, residuals: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Approximate solutions of all pairs' projected correction equations by MINRES, all of them in step.

    ``times`` multiplies a block with the matrix; ``found`` holds the locked vectors and the current Ritz vectors.
    """
    project = lambda t: t - found @ (found.T @ t)
    b = project(project(-residuals))
    beta1 = np.linalg.norm(b, axis=0)
    live = beta1 > 0
    safe = lambda a: np.where(a > 0, a, 1)
    v, v_old, beta = b / safe(beta1), np.zeros_like(b), np.zeros_like(beta1)
    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    rest, cos, sin, eps, bar = beta1.copy(), -np.ones_like(beta1), np.zeros_like(beta1), np.zeros_like(beta1), np.zeros_like(beta1)
    for _ in range(INNER):
        p = project(times(v) - v * values)
        alpha = (v * p).sum(0)
        p = project(p - alpha * v - beta * v_old)
        beta = np.linalg.norm(p, axis=0)
        old_eps, delta, gap = eps, cos * bar + sin * alpha, sin * bar - cos * alpha
        eps, bar = sin * beta, -cos * beta
        gamma = np.hypot(gap, beta)
        live = live & (gamma > 0)
        gamma = safe(gamma)
        cos, sin = gap / gamma, beta / gamma
        step, rest = cos * rest, np.where(live, sin * rest, rest)
        w, w_old = (v - old_eps * w_old - delta * w) / gamma, w
        x = x + np.where(live, step, 0) * w
        v, v_old = p / safe(beta), v
        live = live & (beta > 0) & (rest > ENOUGH * beta1)
        if not live.any():
            break
    return project(x)


def largest(times, size: int, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors as columns, of a symmetric matrix that ``times`` multiplies."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, size)
    block = min(size, wanted + GUARDS)
    most = max(4 * block, 20)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    basis = orthonormal(rng.normal(size=(size, block)))
    images = times(basis)
    scale, stale, best = 0.0, 0, np.inf
    while True:
        theta, turn = np.linalg.eigh((basis.T @ images + images.T @ basis) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        scale = max([scale, *np.abs(theta), *np.abs(values)])
        # Locked directions are projected out of what remains: rounding would bring them back.
        residual = images - basis * theta
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        open_ = min(wanted - locked.shape[1], len(theta))
        worst = sizes[:open_].max(initial=0)
        whole = locked.shape[1] + basis.shape[1] >= size
        stale, best = (stale + 1, best) if worst > best / 2 else (0, worst)
        # Where rounding keeps residuals from falling any further, they are at their floor.
        floor = ROUNDING * EPS * np.sqrt(size) * scale * (1 if stale < 5 and not whole else 100)
        done = sizes[:open_] <= floor
        if done.any():
            pick = np.flatnonzero(done)
            fresh = orthonormal(basis[:, pick], locked)
            locked, values = np.concatenate([locked, fresh], 1), np.concatenate([values, theta[pick]])
            rest = np.setdiff1d(np.arange(len(theta)), pick)
            basis, images, theta, residual, sizes = basis[:, rest], images[:, rest], theta[rest], residual[:, rest], sizes[rest]
            open_, stale, best = open_ - len(pick), 0, np.inf
        if locked.shape[1] >= wanted:
            fresh = orthonormal(rng.normal(size=(size, 4)), locked, basis)
            if not fresh.shape[1] and not basis.shape[1]:
                break
            if fresh.shape[1]:
                basis, images = np.concatenate([basis, fresh], 1), np.concatenate([images, times(fresh)], 1)
            images = images - locked @ (locked.T @ images)
            top = np.linalg.eigvalsh((basis.T @ images + images.T @ basis) / 2)[-1]
            if top <= values.min() + 1e3 * floor:
                break
            out = int(values.argmin())  # a larger pair was missed: the least one goes back into the search
            back = locked[:, [out]]
            locked, values = np.delete(locked, out, 1), np.delete(values, out)
            basis, images = np.concatenate([basis, back], 1), np.concatenate([images, times(back)], 1)
            continue
        if whole and not done.any():
            raise ArithmeticError("residuals do not reach double precision")
        if basis.shape[1] > most:
            keep = 2 * block
            basis, images, theta, residual, sizes = basis[:, :keep], images[:, :keep], theta[:keep], residual[:, :keep], sizes[:keep]
        pairs = [i for i in range(min(open_ + GUARDS, len(theta))) if sizes[i] > floor]
        found = np.concatenate([locked, basis[:, : open_ + GUARDS]], 1)
        new = corrections(times, theta[pairs], residual[:, pairs], found) if pairs else basis[:, :0]
        new = orthonormal(new, locked, basis)
        if not new.shape[1]:
            new = orthonormal(rng.normal(size=(size, block)), locked, basis)
        if new.shape[1]:
            basis, images = np.concatenate([basis, new], 1), np.concatenate([images, times(new)], 1)
        images = images - locked @ (locked.T @ images)
    # One last Rayleigh-Ritz on what was locked, from a fresh product.
    theta, turn = np.linalg.eigh(locked.T @ times(locked))
    return theta[::-1], locked @ turn[:, ::-1]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of integer vectors; None where nothing remains."""
    mid = centre(rows)
    if mid is None:
        return None
    size, whole = len(mid.floor), trace(rows, mid)
    if not whole > 0:
        return Whitening(mid, np.zeros(0), np.zeros((size, 0)), np.zeros(0))
    values, vectors = largest(lambda block: product(rows, mid, block), size, components)
    keep = values > size * EPS * values[0]
    values, vectors = values[keep], vectors[:, keep]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    return Whitening(mid, values, vectors, values / whole)


def whiten(rows: DataFrame, model: Whitening, id_column: str = "vec_id") -> DataFrame:
    """id, deviation and whitened (an array, one entry per component) of every row."""
    turn = model.vectors / np.sqrt(model.values)
    mid = model.centre
    kind = pa.list_(pa.float64())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                rows = [batch.column(id_column), pa.array(mid.deviations(x), pa.string()), pa.array(list(mid.of(x) @ turn), kind)]
                yield pa.RecordBatch.from_arrays(rows, [id_column, "deviation", "whitened"])

    id_type = rows.schema[id_column].dataType.simpleString()
    out = rows.select(id_column, "x").mapInArrow(work, f"{id_column} {id_type}, deviation string, whitened array<double>")
    return out.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened rows' covariance less the identity."""
    turn, mid = model.vectors / np.sqrt(model.values), model.centre

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                w = mid.of(matrix(batch)) @ turn
                total = total + np.concatenate([w.sum(0)[None, :], w.T @ w])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["part"])

    found = np.array(_sum_up(rows, work, "double")).reshape(-1, len(model.values)) / mid.n
    return float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(len(model.values))).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error of every remaining row and component."""
    ship(vectors.sparkSession)
    rows = integers(vectors, id_column, vector)
    model = fit(rows, components)
    columns = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None or not len(model.values):
        none = [F.lit(0).alias("component")] + [F.lit(0).cast("long").alias(c) for c in columns[2:4]] + [F.lit(0.0).alias(c) for c in columns[4:]]
        return rows.where("false").select(id_column, *none)
    out = whiten(rows, model, id_column).select(id_column, "deviation", F.posexplode("whitened").alias("at", "value"))
    return out.select(
        id_column,
        (F.col("at") + 1).alias("component"),
        F.lit(model.centre.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(F.array(*[F.lit(float(v)) for v in model.explained]), F.col("at") + 1).alias("explained"),
        F.lit(identity_error(rows, model)).alias("identity_error"),
    )
