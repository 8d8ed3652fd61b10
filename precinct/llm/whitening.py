"""Whitening of embeddings: QR by blocks of rows, Householder bidiagonalisation, dqds and twisted factorisations.

Vectors are taken as whole numbers, floor(256 * entry), so that the list of distinct vectors, their number and their sums are
exact. Each task reduces its centred rows to a triangle R by QR; triangles meet in a tree until one is left, whose
Gram matrix is that of all rows. R has as many rows as a vector has entries, so it comes to the driver: reflections
bring it to upper bidiagonal form B, dqds finds the singular values of B to high relative accuracy, and for each wanted
one the twisted factorisation of B'B minus its square gives the vector without iterations. The covariance
itself is never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import sorted_groups, tidy
from precinct.session import materialize

SCALE, COMPONENTS = 256, 4
# Whole entries of this size and above are not exact as doubles; such a vector is left out.
EXACT = 1 << 53
# Triangles that one task stacks in a step of the tree.
FAN = 32
_EPS = float(np.finfo(float).eps)


class Whitening(NamedTuple):
    """``n`` distinct vectors with ``sums``, the directions as columns, their eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole part is taken off as integers first."""
        whole, rest = _parts(self.n, self.sums)
        return (x - whole) - rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum over all entries of (n * x - sums)^2; null where it is no long."""
        whole, rest = _parts(self.n, self.sums)
        most = self.n * (int(np.abs(x - whole).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return ((self.n * (x - whole) - rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * (x - whole).astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.eigenvalues)


def _parts(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    parts = [divmod(s, n) for s in sums]
    return np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)


# --- The triangle ---


def triangle(rows: np.ndarray, above: np.ndarray | None = None) -> np.ndarray:
    """R of a QR decomposition of ``rows`` below ``above``."""
    return np.linalg.qr(rows if above is None else np.vstack([above, rows]), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and W, in R = U B W' with orthogonal U and W made of reflections."""
    a, n = np.array(r, float), r.shape[1]
    if a.shape[0] < n:
        a = np.vstack([a, np.zeros((n - a.shape[0], n))])
    w = np.eye(n)

    def mirror(v: np.ndarray) -> tuple[np.ndarray, float]:
        v = v.copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        square = float(v @ v)
        return v, 2.0 / square if square > 0 else 0.0

    for k in range(n):
        v, by = mirror(a[k:, k])
        a[k:, k:] -= np.outer(v, by * (v @ a[k:, k:]))
        if k < n - 2:
            v, by = mirror(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(by * (a[k:, k + 1 :] @ v), v)
            w[:, k + 1 :] -= np.outer(by * (w[:, k + 1 :] @ v), v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), w


# --- Singular values: differential quotient-difference with shifts ---


def _least_bound(q: list[float], e: list[float]) -> float:
    """A lower bound of the least eigenvalue: the trace of the inverse is the sum of 1 / d of a transform without shift."""
    d, total = q[0], 0.0
    for i in range(len(q)):
        if d <= 0:
            return 0.0
        total += 1.0 / d
        if i + 1 < len(q):
            d *= q[i + 1] / (d + e[i])
    return (1.0 - 8 * len(q) * _EPS) / total


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step; None if the shift was above the least eigenvalue."""
    d, new_q, new_e = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        now = d + e[i]
        by = q[i + 1] / now if now > 0 else 0.0
        new_q.append(now)
        new_e.append(e[i] * by)
        d = d * by - shift
    return (new_q + [d], new_e) if d >= 0 else None


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B, the greatest first.

    Shifts stay below the least eigenvalue, so the transforms subtract nothing but the shift; where an
    off-diagonal entry is negligible the array falls into two.
    """
    found: list[float] = []
    work = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    while work:
        q, e, total = work.pop()
        while len(q) > 1:
            cut = next((i for i in reversed(range(len(e))) if e[i] <= (8 * _EPS) ** 2 * (total + min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], total))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = _least_bound(q, e)
            after = _transform(q, e, shift)
            while after is None:  # by rounding alone
                shift = shift / 2 if shift > 1e-300 else 0.0
                after = _transform(q, e, shift)
            q, e = after
            total += shift
        found.append(total + q[0])
    return np.array(sorted(found, reverse=True))


# --- Vectors: twisted factorisations ---


def twisted_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B for ``values``, as columns.

    B'B = L D L'. For each value the factorisations from the top (stationary) and from the bottom (progressive) are joined
    where their residual is least, and the vector follows by multiplications outwards from there. Values that lie close may
    want the same place: then the next places are tried until a vector is found that the earlier ones do not span.
    """
    n = len(diagonal)
    d = diagonal**2
    l = np.append(above / diagonal[:-1], 0.0)[:n] if n > 1 else np.zeros(1)
    tiny = np.finfo(float).tiny / _EPS
    out = np.zeros((n, len(values)))
    for column, value in enumerate(values.tolist()):
        down, up = np.zeros(n), np.zeros(n)
        s, p = np.zeros(n), np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            pivot = s[i] + d[i]
            pivot = pivot if abs(pivot) > tiny else tiny
            down[i] = d[i] * l[i] / pivot
            s[i + 1] = down[i] * l[i] * s[i] - value
        p[n - 1] = d[n - 1] - value
        for i in reversed(range(n - 1)):
            if not l[i]:  # the matrix falls into two here
                p[i] = d[i] - value
                continue
            pivot = d[i] * l[i] * l[i] + p[i + 1]
            pivot = pivot if abs(pivot) > tiny else tiny
            by = d[i] / pivot
            up[i] = l[i] * by
            p[i] = p[i + 1] * by - value
        best, most = None, 0.0
        for k in np.argsort(np.abs(s + p + value), kind="stable").tolist():
            z = np.zeros(n)
            z[k] = 1.0
            for i in reversed(range(k)):
                z[i] = -down[i] * z[i + 1]
            for i in range(k, n - 1):
                z[i + 1] = -up[i] * z[i]
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= out[:, :column] @ (out[:, :column].T @ z)
            left = float(np.linalg.norm(z))
            if left > most:
                best, most = z / left, left
            if left > 0.5:
                break
        out[:, column] = best
    return out


def principal_directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``components`` right singular vectors of R as columns, and squared singular values, the greatest first.

    Directions without variance beyond rounding are left out. The entry of each vector that is greatest in size is positive.
    """
    scale = float(np.abs(r).max(initial=0.0))
    if not scale:
        return np.zeros((r.shape[1], 0)), np.zeros(0)
    diagonal, above, w = bidiagonal(r / scale)
    # A zero on the diagonal is lifted far below rounding, so that B'B has a factorisation.
    least = _EPS * _EPS * max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    diagonal = np.where(np.abs(diagonal) < least, least, diagonal)
    values = squared_singular_values(diagonal, above)
    floor = (16 * len(values) * _EPS) ** 2 * values[0]
    values = values[: min(components, int((values > floor).sum()))]
    directions = w @ twisted_vectors(diagonal, above, values)
    directions /= np.linalg.norm(directions, axis=0)
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
    return directions * signs, values * scale * scale


# --- The distributed steps ---


def whole_entries(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of each entry as longs; null for a vector that is null, empty or holds an entry without one."""
    scaled = F.transform(vector, lambda c: c.cast("double") * scale)
    fits = F.forall(scaled, lambda c: F.coalesce(F.abs(c) < F.lit(float(EXACT)), F.lit(False)))
    return F.when(fits & (F.size(vector) > 0), F.transform(scaled, lambda c: F.floor(c) + F.lit(0)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit_list: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors; upper and lower halves of the entries are summed for themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(length, np.int64), np.zeros(length, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                n += len(x)
                high += (x >> 27).sum(axis=0)
                low += (x & ((1 << 27) - 1)).sum(axis=0)
        columns = [np.arange(length), np.full(length, n), high, low]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["entry", "n", "high", "low"])

    parts = fit_list.mapInArrow(tidy(run), "entry long, n long, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("n", "high", "low")]
    rows = parts.groupBy("entry").agg(*wide).orderBy("entry").collect()  # one row for each entry of a vector
    return (int(rows[0]["n"]), [(int(r["high"]) << 27) + int(r["low"]) for r in rows]) if rows else (0, [])


def _triangle_of(fit_list: DataFrame, model: Whitening) -> np.ndarray:
    """The triangle of all centred vectors."""
    length = len(model.sums)

    def packed(number: int, r: np.ndarray) -> pa.RecordBatch:
        values = pa.array([r.ravel()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), values], names=["part", "r"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if batch.num_rows:
                r = triangle(model.centred(_matrix(batch.column(0))), r)
        if r is not None:
            yield packed(TaskContext.get().partitionId(), r)

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["step"]):
            r = None
            for column in group.column("r").chunks:
                for one in column:
                    r = triangle(one.values.to_numpy().reshape(-1, length), r)
            yield packed(group.column("step")[0].as_py(), r)

    parts = materialize(fit_list.mapInArrow(tidy(first), "part long, r array<double>"), "triangles")
    while parts.limit(2).count() > 1:
        step = F.floor(F.col("part") / FAN).cast("long").alias("step")
        stacked = parts.select(step, "part", "r").repartition("step").sortWithinPartitions("step", "part")
        parts = materialize(stacked.mapInArrow(tidy(stack), "part long, r array<double>"), "triangles")
    return np.array(parts.first()["r"]).reshape(-1, length)


def fit(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the distinct vectors of ``embeddings``, and their list (x array<long>), stored in the shared folder.

    Vectors that are null, empty, or hold entries that are null, not finite or too large to be exact are left out, and so
    are those of another length than most have (the smaller of equally frequent ones). Equal vectors count once. Without
    any vector there is no whitening. The driver holds one triangle: entries of a vector squared.
    """
    x = whole_entries(F.col(vector)).alias("x")
    fit_list = materialize(embeddings.select(x).filter("x is not null").distinct(), "fit-list")
    by_length = fit_list.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    common = by_length.orderBy(F.desc("n"), "length").first()
    if common is None:
        return None, fit_list
    fit_list = fit_list.filter(F.size("x") == common["length"])
    n, sums = _sums(fit_list, common["length"])
    empty = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    r = _triangle_of(fit_list, empty)
    directions, squares = principal_directions(r, components)
    return Whitening(n, sums, directions, squares / n, float((r * r).sum()) / n), fit_list


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """The greatest difference, in size, between the covariance of the whitened vectors and the identity."""
    size = len(model.eigenvalues)
    if not size:
        return 0.0
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_matrix(batch.column(0)))
                sums += w.sum(axis=0)
                products += w.T @ w
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(products[i, j]), pa.array(sums[i]), pa.array(sums[j])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "product", "a", "b"])

    # The rows are centred already, so their means are no more than rounding.
    parts = fit_list.mapInArrow(tidy(run), "i int, j int, product double, a double, b double")
    n = model.n
    covariance = F.sum("product") / n - (F.sum("a") / n) * (F.sum("b") / n)
    wanted = F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)
    entries = parts.groupBy("i", "j").agg(covariance.alias("c")).select(F.abs(F.col("c") - wanted).alias("error"))
    return float(entries.agg(F.max("error")).first()[0])


def whiten(embeddings: DataFrame, model: Whitening | None, *keep: str, vector: str = "embedding") -> DataFrame:
    """(``keep``, component, n, deviation, whitened, explained): a row for each vector and component.

    Left out are the vectors that ``fit`` leaves out. Repeated rows give repeated results; components are numbered from 1;
    one without variance is not there, so equal vectors alone give no rows.
    """
    x = whole_entries(F.col(vector)).alias("__x")
    rows = embeddings.select(*keep, x)
    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    schema = ", ".join(x for x in (kept, "component int, n long, deviation long, whitened double, explained double") if x)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    names = [*rows.columns[:-1], "component", "n", "deviation", "whitened", "explained"]
    size = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not size:
                continue
            x = _matrix(batch.column(batch.num_columns - 1))
            row = pa.array(np.repeat(np.arange(len(x)), size))
            columns = [batch.column(c).take(row) for c in range(batch.num_columns - 1)]
            columns += [
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(row), model.n, np.int64)),
                pa.array(model.deviation(x), pa.int64()).take(row),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.eigenvalues / model.trace, len(x))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.filter(F.size("__x") == len(model.sums)).mapInArrow(tidy(run), schema)
