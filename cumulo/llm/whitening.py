"""Embedding whitening by contour integration.

Entries become whole numbers, floor(SCALE * c) + SHIFT, so that sums and squared distances are exact.
Two passes over the vectors give their sums and then the covariance of the centred vectors: every task
reduces its rows to one small matrix before the shuffle. The matrix has one row per dimension; it goes
to the driver, where the eigenvalue problem is solved, since its size depends on the vectors' length
alone. A third pass projects all vectors.

The eigenvalue problem: counts of eigenvalues above a shift (the inertia of the shifted tridiagonal
form, by Sylvester's law) place an interval around the wanted ones and cut it where the spectrum has
gaps. In each piece, quadrature of shifted solves along a circle around it projects a random block onto
the piece's eigenspace, Rayleigh-Ritz extracts the vectors, and this repeats until the residuals are at
rounding level. The inertia says how many must be found; a piece that lacks one is done again with a
wider block, so none is missed.

A row whose vector is null or empty or holds null or non-finite entries is left out, and so is one of
another length than most vectors have (the longer one if lengths are equally frequent). Rows without an
id stay. Repeated rows count each. Scaled entries stop at 2**62 in size; a deviation beyond 38 digits is
null. A component without variance has no ``whitened``; ``explained`` is null if no
component has any. An empty table gives no rows. Columns besides the id and the vector are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import stage

SCALE, SHIFT = 1024, 100_000
BOUND = 2.0**62
# Points on the half circle; the other half is its mirror image.
NODES = 8
SEED = 5
# Eigenvalues below this share of the largest are rounding noise.
NOISE = 1e-13
# Whole numbers whose square times the row count may pass 64 bits are multiplied as Python integers.
SMALL = 1 << 31


# ---- eigenvalues of a small symmetric matrix -----------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0 or np.linalg.norm(x[1:]) == 0:
            continue
        x[0] += math.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        p = a[k + 1 :, k + 1 :] @ x
        w = 2 * (p - (x @ p) * x)
        a[k + 1 :, k + 1 :] -= np.outer(x, w) + np.outer(w, x)
        column = a[k + 1 :, k] - 2 * x * (x @ a[k + 1 :, k])
        a[k + 1 :, k] = a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, 1) ** 2


def inertia(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    above = (pivot > 0).astype(np.int64)
    for d, o in zip(diagonal[1:], off):
        with np.errstate(over="ignore"):
            pivot = d - shifts - o / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        above += pivot > 0
    return above


def values_above(diagonal: np.ndarray, off: np.ndarray, wanted: int, scale: float) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, by bisection of the inertia, all at once. Accurate
    enough to tell gaps; the vectors' own quotients give the final values."""
    low, high = np.full(wanted, -scale), np.full(wanted, scale)
    for _ in range(60):
        middle = (low + high) / 2
        inside = inertia(diagonal, off, middle) > np.arange(wanted)
        low, high = np.where(inside, middle, low), np.where(inside, high, middle)
    return (low + high) / 2


def intervals(values: np.ndarray, wanted: int, scale: float) -> list[tuple[float, float, int]]:
    """Pieces (low, high, number of eigenvalues) that together hold the ``wanted`` largest.

    Bounds lie in gaps: a piece ends where the next value is at most half, or after the wanted ones at
    the first gap that rounding cannot close."""
    ends, close = [], 1e-9 * scale
    for i in range(len(values)):
        gap = values[i] - values[i + 1] if i + 1 < len(values) else math.inf
        if gap > close and (i + 1 >= wanted or gap > values[i] / 2):
            ends.append(i + 1)
        if ends and ends[-1] >= wanted:
            break
    out, start, top = [], 0, values[0] + max(close, 1e-3 * abs(values[0]))
    for end in ends:
        following = values[end] if end < len(values) else values[end - 1] - max(close, abs(values[end - 1]) / 2)
        bottom = (values[end - 1] + following) / 2
        out.append((bottom, top, end - start))
        start, top = end, bottom
    return out


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """The block under the spectral projector of the interval: Gauss-Legendre quadrature of complex
    shifted solves along the circle around it. The lower half circle is the conjugate of the upper."""
    points, weights = np.polynomial.legendre.leggauss(nodes)
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for x, w in zip(points, weights):
        turn = np.exp(1j * math.pi * (1 - x) / 2)
        solved = np.linalg.solve((middle + radius * turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += w / 2 * radius * (turn * solved).real
    return out


def contour_pairs(matrix: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in the interval; ``count`` is known from the inertia."""
    n = len(matrix)
    width = min(n, count + max(2, count // 2))
    for attempt in range(8):
        block = np.random.default_rng([SEED, attempt]).standard_normal((n, width))
        for _ in range(24):
            basis = np.linalg.qr(project(matrix, block, low, high, NODES))[0]
            values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turn
            inside = np.flatnonzero((values > low) & (values < high))
            rest = matrix @ block[:, inside] - block[:, inside] * values[inside]
            residual = np.linalg.norm(rest, axis=0).max(initial=0.0)
            if len(inside) == count and residual <= 50 * np.finfo(float).eps * scale:
                order = inside[np.argsort(-values[inside])]
                return values[order], block[:, order]
        width = min(n, 2 * width)
    raise ArithmeticError(f"found {len(inside)} of {count} eigenvalues between {low} and {high}")


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns. The sign is
    that of the entry of largest size, made positive."""
    n = len(matrix)
    wanted = min(wanted, n)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(wanted), np.eye(n)[:, :wanted]
    diagonal, off = tridiagonal(matrix)
    pieces = intervals(values_above(diagonal, off, n, 1.01 * scale), wanted, scale)
    values, vectors = zip(*(contour_pairs(matrix, low, high, count, scale) for low, high, count in pieces))
    values, vectors = np.concatenate(values)[:wanted], np.concatenate(vectors, axis=1)[:, :wanted]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


# ---- passes over the vectors ---------------------------------------------------------------------


def _rows(batch: pa.RecordBatch, length: int) -> np.ndarray:
    """The vectors of a batch as doubles, one per row."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def whole(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * vectors)
    return np.clip(scaled, -BOUND, BOUND).astype(np.int64) + SHIFT


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n x - S) squared, exact."""
    if np.abs(x).max(initial=0) < SMALL and n < SMALL and max(map(abs, sums)) < 1 << 62:
        apart = x * n - np.array(sums, dtype=np.int64)
        if (float(np.abs(apart).max(initial=0)) + 1) ** 2 * x.shape[1] < 1 << 62:
            return (apart * apart).sum(axis=1).tolist()
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``row_id`` and ``embedding`` of the rows that the fit list and the result hold."""
    value = F.col(column).cast("array<double>")
    finite = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_column).alias("row_id"), value.alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0))


def _summed(parts: DataFrame, length: int) -> np.ndarray:
    """Rows (``place``, ``task``, ``part``: doubles) added up by place, in the order of the tasks."""
    schema = pa.schema([("place", pa.int32()), ("part", pa.binary())])

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("task").to_numpy(), kind="stable")
        total = np.zeros(length)
        blocks = table.column("part")
        for i in order.tolist():
            total += np.frombuffer(blocks[i].as_py())
        return pa.table([table.column("place").slice(0, 1), [total.tobytes()]], schema=schema)

    found = parts.groupBy("place").applyInArrow(add, "place int, part binary").toArrow()
    out = np.zeros((length, length))
    for place, part in zip(found.column("place").to_pylist(), found.column("part").to_pylist()):
        out[place] = np.frombuffer(part)
    return out


def sums(rows: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their whole entries."""

    def add(batches):
        total, n = [0] * length, 0
        for batch in batches:
            n += batch.num_rows
            x = whole(_rows(batch, length))
            for low in range(0, len(x), SMALL >> 12):
                part = x[low : low + (SMALL >> 12)]
                if np.abs(part).max(initial=0) < SMALL:
                    own = part.sum(axis=0).tolist()
                else:
                    own = part.astype(object).sum(axis=0).tolist()
                total = [a + b for a, b in zip(total, own)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(length + 1), pa.int32()), pa.array(map(str, [*total, n]), pa.string())], names=["place", "total"]
        )

    parts = rows.select("embedding").mapInArrow(add, "place int, total string")
    found = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    by_place = {r["place"]: int(r["total"]) for r in found}
    return by_place.get(length, 0), [by_place.get(i, 0) for i in range(length)]


def covariance(rows: DataFrame, length: int, n: int, totals: list[int]) -> np.ndarray:
    """Covariance (divisor n) of the whole entries, centred before multiplying."""
    mean = np.array([s / n for s in totals])

    def multiply(batches):
        from pyspark import TaskContext

        total = np.zeros((length, length))
        for batch in batches:
            apart = whole(_rows(batch, length)) - mean
            total += apart.T @ apart
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(length), pa.int32()),
                pa.array([task] * length, pa.int32()),
                pa.array([row.tobytes() for row in total], pa.binary()),
            ],
            names=["place", "task", "part"],
        )

    total = _summed(rows.select("embedding").mapInArrow(multiply, "place int, task int, part binary"), length)
    return (total + total.T) / (2 * n)


def whiten(
    vectors: DataFrame, components: int = 8, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """Per vector and component (numbered from 1 by falling variance): the id column, ``component``,
    ``n``, ``deviation`` (decimal), ``whitened``, ``explained`` (share of the variance) and
    ``identity_error`` (largest entry by which the covariance of the whitened values misses the
    identity; null without variance)."""
    rows = usable(vectors, id_column, column)
    id_type = dict(rows.dtypes)["row_id"]
    lengths = rows.groupBy(F.size("embedding").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if common is None:
        types = [id_type, "int", "long", "decimal(38,0)", "double", "double", "double"]
        return rows.limit(0).select(*[F.lit(None).cast(t).alias(c) for c, t in zip(names, types)])
    length = common["d"]
    rows = rows.where(F.size("embedding") == length)
    n, totals = sums(rows, length)
    matrix = covariance(rows, length, n, totals)
    values, directions = leading_pairs(matrix, components)
    trace = float(np.trace(matrix))
    live = int((values > max(NOISE * trace, 0.0)).sum())
    weights = directions[:, :live] / np.sqrt(values[:live])
    mean = np.array([s / n for s in totals])

    def run(batches):
        for batch in batches:
            x = whole(_rows(batch, length))
            found = (x - mean) @ weights
            exact = [str(v) if v < 10**38 else None for v in deviations(x, n, totals)]
            offsets = np.arange(len(x) + 1, dtype=np.int32) * live
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(exact, pa.string()), listed], names=["row_id", "deviation", "scores"]
            )

    scored = rows.mapInArrow(run, f"row_id {id_type}, deviation string, scores array<double>")
    scored = stage(scored.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")), "whitened")
    error = None
    if live:
        means = scored.agg(*[F.avg(F.col("scores")[i]).alias(f"m{i}") for i in range(live)]).first()
        apart = [F.col("scores")[i] - F.lit(means[i]) for i in range(live)]
        pairs = [(i, j) for i in range(live) for j in range(i, live)]
        found = scored.agg(*[(F.sum(apart[i] * apart[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))
    shares = F.array(*[F.lit(float(v) / trace if trace else None).cast("double") for v in values])
    place = F.explode(F.sequence(F.lit(0), F.lit(len(values) - 1)))
    return scored.withColumn("_place", place).select(
        F.col("row_id").alias(id_column),
        (F.col("_place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.get("scores", F.col("_place")).alias("whitened"),
        F.get(shares, F.col("_place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
