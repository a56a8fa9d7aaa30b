"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors are arrays of longs (fixed-point embeddings). The fit list holds each distinct vector once, so copies weigh nothing;
equal vectors meet inside each task before they move. Three narrow passes over the fit list: the exact sums of every dimension;
the scatter of the centred vectors, as one matrix a task, of which Spark then adds up row by row; and the covariance of the whitened
vectors, which measures the result. Only matrices of dimensions x dimensions reach the driver, whatever the number of vectors.

There the scatter A is factored as P'AP = LL' with the largest remaining diagonal entry as pivot; entries below rounding
end it, which gives the rank. Jacobi rotations from the right make the columns of L orthogonal: LJ = US. So A = PUSS'U'P' and
no squared condition enters: column norms squared are the eigenvalues (times n) and the normalised columns the components.
Pairs of columns rotate in the order of a round-robin tournament, half of all columns at once.

Defined cases: rows whose vector is NULL or holds a NULL are dropped. Each length of vectors is a table of its own, with its
own fit; vectors of no entries have no components. There are at most as many components as the rank, so vectors that are all equal have
none. Equal eigenvalues are numbered as they come; a component's largest entry is positive. Repeated rows are each returned.
Entries must lie within 2^53, where a double still holds them; ``deviation`` is exact at any size. The driver needs some 50 bytes for each entry of
the scatter (dimensions squared).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, packed

MOST_SWEEPS = 60
PART = "size int, place int, part binary"


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``L`` (rows x rank) and ``order`` with ``a[order][:, order] = L @ L.T`` up to rounding."""
    size = len(a)
    rest, order = a.copy(), np.arange(size)
    lower = np.zeros((size, size))
    least = size * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        pivot = k + int(np.argmax(rest.diagonal()[k:]))
        if not rest[pivot, pivot] > least:
            return lower[:, :k], order
        for m in (rest, rest.T, lower):
            m[[k, pivot]] = m[[pivot, k]]
        order[[k, pivot]] = order[[pivot, k]]
        lower[k, k] = np.sqrt(rest[k, k])
        lower[k + 1:, k] = rest[k + 1:, k] / lower[k, k]
        rest[k + 1:, k + 1:] -= np.outer(lower[k + 1:, k], lower[k + 1:, k])
    return lower, order


def rounds(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``count`` columns, each once, as rounds of disjoint pairs: a round-robin tournament."""
    seats = np.arange(count + count % 2)
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        left, right = seats[:half], seats[half:][::-1]
        real = (left < count) & (right < count)
        yield left[real], right[real]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def one_sided_jacobi(columns: np.ndarray) -> np.ndarray:
    """The matrix times a rotation that makes its columns orthogonal to working precision."""
    turned = np.ascontiguousarray(columns.T)  # rows are contiguous
    bound = 4 * np.sqrt(max(len(columns), 1)) * np.finfo(float).eps  # what rounding leaves of a product
    for _ in range(MOST_SWEEPS):
        worst = 0.0
        for p, q in rounds(len(turned)):
            if not len(p):
                continue
            x, y = turned[p], turned[q]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            size = np.sqrt(xx) * np.sqrt(yy)
            skew = np.abs(xy) / np.where(size > 0, size, 1)
            worst = max(worst, skew.max())
            turn = skew > bound
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1)
            tangent = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.hypot(1, zeta))
            tangent = np.where(turn, tangent, 0)[:, None]
            cosine = 1 / np.hypot(1, tangent)
            turned[p], turned[q] = cosine * (x - tangent * y), cosine * (y + tangent * x)
        if worst <= bound:
            break
    return turned.T


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix without negative ones."""
    lower, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(lower)
    norms = np.sqrt((turned * turned).sum(0))
    first = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(turned)
    vectors[order] = turned
    vectors, norms = vectors[:, first], norms[first]
    vectors = vectors / np.where(norms > 0, norms, 1)
    if vectors.size:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(norms))])
    return norms * norms, vectors


@dataclass
class Fit:
    """Mean (``base`` + ``rest``, an integer and a fraction), exact sums about ``base``, and components of one length of vectors."""

    n: int
    base: np.ndarray
    sums: list[int]
    rest: np.ndarray
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S)^2, exact."""
        z = x - self.base
        most = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, self.sums), default=0)
        if z.shape[1] * most * most < 1 << 63:
            y = self.n * z - np.array(self.sums, dtype=np.int64)
            return pa.array((y * y).sum(1)).cast(pa.decimal128(38))
        y = self.n * z.astype(object) - np.array(self.sums, dtype=object)
        sums = [int(v) for v in (y * y).sum(1)]
        return pa.array([Decimal(v) if v < 10**38 else None for v in sums], pa.decimal128(38))


def matrices(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) for each length of the list column."""
    lists = batch.column(column)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        own = lists if len(at) == len(lengths) else lists.take(pa.array(at))
        yield size, at, pc.list_flatten(own).to_numpy(zero_copy_only=False).reshape(len(at), size)


def gram(fit_list: DataFrame, of: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """By length of vectors: the sum of m' m over all their rows, where m is ``of`` a block of rows.

    A task adds up its own matrix; the tasks' matrices are then added row by row of the matrix, each in another group.
    """

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in matrices(batch):
                if size:
                    m = of(size, x)
                    held[size] = held.get(size, 0) + m.T @ m
        for size, total in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total])],
                names=["size", "place", "part"],
            )

    def add(rows: pa.Table) -> pa.Table:
        parts = np.array([np.frombuffer(p) for p in rows.column("part").to_pylist()])
        return rows.slice(0, 1).set_column(2, "part", pa.array([parts.sum(0).tobytes()]))

    found: dict[int, dict[int, np.ndarray]] = {}
    for r in fit_list.mapInArrow(run, PART).groupBy("size", "place").applyInArrow(add, PART).collect():
        found.setdefault(r.size, {})[r.place] = np.frombuffer(r.part)
    return {size: np.array([rows[k] for k in range(len(rows))]) for size, rows in found.items()}


def _sums(fit_list: DataFrame) -> dict[int, Fit]:
    """Exact number and sums of the vectors, by length."""

    def run(batches):
        for batch in batches:
            for size, at, x in matrices(batch):
                # Sums of the two halves of the entries cannot overflow, whatever the entries.
                high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([len(at)] * size, pa.int64()), pa.array(high), pa.array(low)],
                    names=["size", "place", "n", "high", "low"],
                )

    wide = "decimal(38,0)"
    parts = fit_list.mapInArrow(run, "size int, place int, n long, high long, low long")
    rows = parts.groupBy("size", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")
    ).orderBy("size", "place").collect()
    fits: dict[int, Fit] = {}
    for size in sorted({r.size for r in rows}):
        own = [r for r in rows if r.size == size]
        n = int(own[0].n)
        totals = [(int(r.high) << 32) + int(r.low) for r in own]
        base = [t // n for t in totals]
        sums = [t - n * b for t, b in zip(totals, base)]
        fits[size] = Fit(n, np.array(base, dtype=np.int64), sums, np.array([s / n for s in sums]))
    return fits


def fit(vectors: DataFrame, vector: Column, components: int = 16) -> dict[int, Fit]:
    """The whitening of the distinct vectors, by their length; runs jobs."""
    scratch = Scratch(vectors.sparkSession, "whitening")
    distinct = scratch.keep(_usable(packed(vectors, x=vector)).select("x").distinct(), "fit-list")
    fits = _sums(distinct)
    scatters = gram(distinct, lambda size, x: fits[size].centred(x))
    for size, own in fits.items():
        values, turned = eigen(scatters[size])
        own.trace = scatters[size].trace() / own.n
        own.values, own.vectors = values[:components] / own.n, turned[:, :components]
    # The column of ones gives the whitened vectors' own mean.
    for size, total in gram(distinct, lambda size, x: np.column_stack([fits[size].whitened(x), np.ones(len(x))])).items():
        own, k = fits[size], len(fits[size].values)
        mean = total[k, :k] / own.n
        error = total[:k, :k] / own.n - np.outer(mean, mean) - np.eye(k)
        own.identity_error = float(np.abs(error).max(initial=0.0))
    scratch.drop()
    return fits


def _usable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.forall("x", lambda c: c.isNotNull()))


COMPONENT = pa.struct([("component", pa.int32()), ("whitened", pa.float64()), ("explained", pa.float64())])


def whiten(vectors: DataFrame, vector: Column, fits: dict[int, Fit]) -> DataFrame:
    """``row``, ``n``, exact ``deviation`` (decimal), ``identity_error`` and ``components`` (number, whitened, explained) of each row.

    A row whose length has no fit is dropped, like one without a usable vector.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in matrices(batch):
                if not size or size not in fits:
                    continue
                own = fits[size]
                k, count = len(own.values), len(at)
                parts = pa.StructArray.from_arrays(
                    [
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)), pa.array(own.whitened(x).ravel()),
                        pa.array(np.tile(own.values / own.trace if k else own.values, count)),
                    ],
                    fields=list(COMPONENT),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(pa.array(at)), pa.array([own.n] * count, pa.int64()), own.deviation(x),
                        pa.array([own.identity_error] * count), pa.ListArray.from_arrays(np.arange(count + 1, dtype=np.int32) * k, parts),
                    ],
                    names=["row", "n", "deviation", "identity_error", "components"],
                )

    rows = packed(vectors, x=vector)
    kind = rows.schema["row"].dataType.simpleString()
    components = "array<struct<component: int, whitened: double, explained: double>>"
    return _usable(rows).mapInArrow(run, f"row {kind}, n long, deviation decimal(38,0), identity_error double, components {components}")
