"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The vectors become whole numbers, so counts, sums and deviations are exact. The leading
eigenvectors of their covariance V are found without V: every step is one pass over the
fit list in which tasks multiply their centred rows with a slim matrix Q and send the
sums of XᵀXQ. A Chebyshev polynomial of V, made of such passes, damps the eigenvalues
below a bound; QR and Rayleigh-Ritz then turn the block until its residuals certify it.
The driver holds matrices of the width of a vector times the block, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import map_arrow
from platewise.session import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Vectors carried beside the wanted ones, degree of the polynomial, and most rounds.
GUARD, DEGREE, ROUNDS = 16, 12, 60
# Residual that certifies, as a share of the largest eigenvalue, and one that still does once it stops falling.
CERTIFIED, STALLED = 2e-14, 1e-11
# Eigenvalues below this share of the trace are rounding: they cannot be whitened.
NOTHING = 1e-13
BLOCK_ROWS = 2048
SEED = 20


@dataclass(frozen=True)
class Whitening:
    """A fit: count and sums of the fit list, unit components in columns, eigenvalues, quality."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def whole_numbers(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """The rows whose vector has only finite entries, with ``x``, the entries as whole numbers.

    An entry beyond the range of 64 bits raises: no long holds it.
    """
    entries = F.col(f"`{vector_col}`").cast("array<double>")

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def whole(c: Column) -> Column:
        # Spark may evaluate this before the filter, so it asks for itself.
        held = F.when(F.abs(c * SCALE) < 9e18, F.floor(c * SCALE) + OFFSET)
        return F.when(finite(c), F.coalesce(held, F.raise_error(F.lit("entry beyond 64 bits")).cast("long")))

    kept = entries.isNotNull() & F.forall(entries, finite)
    return vectors.filter(kept).withColumn("x", F.transform(entries, whole))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_list(whole: DataFrame) -> DataFrame:
    """Each distinct vector once, packed: rows of ``size`` vectors in one binary ``block``."""

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.column(0).slice(begin, BLOCK_ROWS)
            x = part.flatten().to_numpy(zero_copy_only=False).astype("<i8")
            yield {"size": [len(part)], "block": [x.tobytes()]}

    distinct = whole.filter(F.size("x") > 0).select("x").distinct()
    return materialize(map_arrow(distinct, pack, "size long, block binary"), "fit-list")


def _sums(df: DataFrame, width: int, per_block: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of the matrices that ``per_block`` gives; a task adds its own before it sends one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for held in batch.column(0):
                found = per_block(np.frombuffer(held.as_buffer(), dtype="<i8").reshape(-1, width))
                total = found if total is None else total + found
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "value"]
            )

    parts = df.select("block").mapInArrow(run, f"place int, value {kind}")
    # As many rows as a matrix has entries, however many vectors there are.
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    values = np.zeros(found.num_rows, dtype=np.int64 if kind == "long" else np.float64)
    values[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return values


class _Covariance:
    """Products with the covariance of the fit list, each one pass over it."""

    def __init__(self, blocks: DataFrame, n: int, sums: list[int], width: int):
        self.blocks, self.n, self.width = blocks, n, width
        self.centre = centring(n, sums)

    def times(self, q: np.ndarray) -> np.ndarray:
        centre, n = self.centre, self.n

        def product(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ q) / n

        return _sums(self.blocks, self.width, product).reshape(q.shape)

    def trace(self) -> float:
        centre, n = self.centre, self.n
        return float(_sums(self.blocks, self.width, lambda x: np.array([np.square(centre(x)).sum() / n]))[0])

    def identity_error(self, projection: np.ndarray) -> float:
        """Largest entry of the whitened rows' covariance less the identity."""
        centre, n, k = self.centre, self.n, projection.shape[1]

        def moments(x: np.ndarray) -> np.ndarray:
            z = centre(x) @ projection
            return np.vstack([z.sum(axis=0), z.T @ z]) / n

        found = _sums(self.blocks, self.width, moments).reshape(k + 1, k)
        return float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())


def centring(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n as doubles, each from the whole number n (x - floor(S/n)) - S mod n where that fits."""
    floors = np.array([s // n for s in sums], dtype=np.int64)
    rests = np.array([s % n for s in sums], dtype=np.float64)

    def centre(x: np.ndarray) -> np.ndarray:
        return (x - floors).astype(np.float64) - rests / n

    return centre


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, their vectors and the products of V with these."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def leading_eigenvectors(
    times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, guard: int = GUARD, degree: int = DEGREE
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit vectors, by products with the matrix alone.

    A block of ``wanted + guard`` vectors goes through the scaled Chebyshev recurrence
    of ``degree`` products that keeps the spectrum from its lower end to the block's
    smallest Ritz value small, and is turned by QR and Rayleigh-Ritz. Residuals at the level
    of rounding certify the wanted pairs; where they stop falling just above it that is
    taken, and beyond ``ROUNDS`` rounds the fit fails.
    """
    size = min(width, wanted + guard)
    q, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, size)))
    values, q, vq = _ritz(q, times(q))
    low = _lower_end(times, q, vq) if size < width else 0.0
    last = np.inf
    for _ in range(ROUNDS):
        top = max(values[0], 0.0)
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted].max(initial=0.0)
        if residual <= CERTIFIED * top or (residual <= STALLED * top and residual > last / 2):
            return values[:wanted], q[:, :wanted]
        last = residual
        low = min(low, max(values[-1], 0.0))
        half, middle = (values[-1] - low) / 2, (values[-1] + low) / 2
        if size < width and not (half > NOTHING * top and top > values[-1]):
            # Nothing to damp: the block reaches into the null space, or all its values are equal.
            q = vq
        elif size < width:
            first = scale = half / (middle - top)
            before, q = q, (vq - middle * q) * (scale / half)
            for _ in range(degree - 1):
                following = 1 / (2 / first - scale)
                before, q = q, 2 * following / half * (times(q) - middle * q) - scale * following * before
                scale = following
        q, _ = np.linalg.qr(q)
        values, q, vq = _ritz(q, times(q))
    raise ArithmeticError("the components could not be certified")


def _lower_end(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray) -> float:
    """A low estimate of the smallest eigenvalue, by two steps of a block Krylov space.

    It only sets the interval that the polynomial damps. One too high costs rounds, as
    some of the lowest spectrum is then amplified too, but no result.
    """
    basis, products = q, vq
    for _ in range(2):
        rest = products[:, -q.shape[1] :]
        for _ in range(2):
            rest = rest - basis @ (basis.T @ rest)
        room = min(rest.shape[1], len(q) - basis.shape[1])
        if room <= 0:
            break
        added = np.linalg.qr(rest)[0][:, :room]
        added, _ = np.linalg.qr(added - basis @ (basis.T @ added))
        basis, products = np.hstack([basis, added]), np.hstack([products, times(added)])
    values, q, vq = _ritz(basis, products)
    return max(0.0, values[-1] - np.linalg.norm(vq[:, -1] - q[:, -1] * values[-1]))


def fit_whitening(whole: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``whole_numbers``; nothing where no direction varies.

    Vectors of different lengths have no common covariance and raise.
    """
    blocks = fit_list(whole)
    widths = [r.width for r in blocks.select((F.octet_length("block") / F.col("size") / 8).cast("int").alias("width")).distinct().limit(2).collect()]
    if not widths:
        return None
    if len(widths) > 1 or whole.filter(F.size("x") > 0).filter(F.size("x") != widths[0]).limit(1).count():
        raise ValueError("vectors of different lengths")
    width = widths[0]
    n = blocks.agg(F.sum("size")).first()[0]

    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])

    parts = [int(v) for v in _sums(blocks, width, halves, "long")]
    sums = [(high << 32) + low for high, low in zip(parts[:width], parts[width:])]
    covariance = _Covariance(blocks, n, sums, width)
    trace = covariance.trace()
    if not trace > 0:
        return None
    values, vectors = leading_eigenvectors(covariance.times, width, min(components, width))
    kept = int((values > NOTHING * trace).sum())
    values, vectors = values[:kept], vectors[:, :kept]
    # The largest entry of a component is positive; the first of equal ones counts.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    vectors = vectors * signs
    return Whitening(n, sums, vectors, values, trace, covariance.identity_error(vectors / np.sqrt(values)))


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sums of (n x - S)² as whole numbers, null where no long holds one."""
    rough = np.square(n * x.astype(np.float64) - sums.astype(np.float64)).sum(axis=1)
    if rough.max(initial=0.0) < 4e18:
        floors = np.array([int(s) // n for s in sums], dtype=np.int64)
        rests = np.array([int(s) % n for s in sums], dtype=np.int64)
        return np.square(n * (x - floors) - rests).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return [d if d < 1 << 63 else None for d in exact]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row a vector and component: ``vec_id``, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is null or holds null or non-finite entries take no part, neither
    do empty vectors; repeated rows and vectors are whitened each but fitted once, a
    null id stays null, and other columns are not read. Components of no variance, all
    of them if fewer than two different vectors are left, cannot be whitened and give no
    row; so does an empty table. Among equal eigenvalues any basis of their plane
    is right; one is taken for all rows. ``deviation`` is null where it exceeds a long.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("entries"))
    whole = whole_numbers(rows, "entries").select("vec_id", "x").filter(F.size("x") > 0)
    fit = fit_whitening(whole, components)
    if fit is None or not len(fit.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    projection = fit.components / np.sqrt(fit.eigenvalues)
    explained = fit.eigenvalues / fit.trace
    centre, sums = centring(fit.n, fit.sums), np.array(fit.sums, dtype=object)
    width, k = projection.shape

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(begin, BLOCK_ROWS)
            x = _rows(part.column(1), width)
            size = len(x)
            row = np.repeat(np.arange(size), k)
            yield {
                "vec_id": part.column(0).take(pa.array(row)),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), size),
                "n": np.full(size * k, fit.n),
                "deviation": pa.array(_deviations(x, fit.n, sums), type=pa.int64()).take(pa.array(row)),
                "whitened": (centre(x) @ projection).ravel(),
                "explained": np.tile(explained, size),
                "identity_error": np.full(size * k, fit.identity_error),
            }

    return map_arrow(whole, run, schema)
