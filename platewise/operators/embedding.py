"""Two-dimensional view of a cohort.

The plane of the two leading principal components is found by products of the
standardised features X with slim matrices: each is one pass in which tasks multiply
their rows and send the sums of XᵀXQ. No matrix of features by features exists anywhere,
so thousands of features cost thousands of numbers a vector, not millions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.columns import columns
from platewise.functions.vectors import constant_vector, dot
from platewise.operators.features import VECTOR, FeatureTable, require, standardise
from platewise.session import materialize

MIN_WELLS = 5
MIN_FEATURES = 2
COMPONENTS = 2
# Vectors of a block, blocks of a basis before it is restarted, and most restarts.
BLOCK, STEPS, RESTARTS = 6, 8, 50
# Residual as a share of the largest eigenvalue that ends the search, and one that does once it stops falling.
CLOSE, STALLED = 1e-13, 1e-9
BLOCK_ROWS = 1024
SEED = 11


def packed_rows(rows: DataFrame) -> DataFrame:
    """The vectors in blocks of rows, one binary each, written once for many passes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.column(0).slice(begin, BLOCK_ROWS)
                values = part.flatten().to_numpy(zero_copy_only=False).astype("<f8")
                yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], type=pa.binary())], names=["block"])

    return materialize(rows.select(VECTOR).mapInArrow(pack, "block binary"), "packed-rows")


def gram_times(packed: DataFrame, q: np.ndarray, scale: float) -> np.ndarray:
    """XᵀXq times ``scale``: a task adds what its blocks give, the driver gets a matrix like ``q``."""
    width = q.shape[0]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for held in batch.column(0):
                x = np.frombuffer(held.as_buffer(), dtype="<f8").reshape(-1, width)
                found = x.T @ (x @ q)
                total = found if total is None else total + found
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "value"])

    parts = packed.mapInArrow(multiply, "place long, value double")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(q.size)
    out[found.column("place").to_numpy()] = found.column("value").to_numpy()
    return out.reshape(q.shape) * scale


def leading_vectors(times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int = COMPONENTS) -> np.ndarray:
    """Unit eigenvectors of the largest eigenvalues, by products with blocks alone.

    A block's successive products span a space whose best approximations (Rayleigh-Ritz)
    are the next block, until the residuals of the wanted ones are at rounding level.
    Where eigenvalues beyond the wanted are equal to these any vectors of their space do.
    """
    size = min(width, max(BLOCK, wanted))
    block, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, size)))
    product, last = times(block), np.inf
    for _ in range(RESTARTS):
        basis, products = block, product
        for _ in range(STEPS - 1):
            rest = products[:, -size:]
            for _ in range(2):
                rest = rest - basis @ (basis.T @ rest)
            room = min(rest.shape[1], width - basis.shape[1])
            # Directions that are rounding only would be noise in the basis.
            turned, sizes, _ = np.linalg.svd(rest, full_matrices=False)
            room = min(room, int((sizes > 1e-13 * np.abs(products).max(initial=0.0)).sum()))
            if room <= 0:
                break
            added = turned[:, :room]
            added, _ = np.linalg.qr(added - basis @ (basis.T @ added))
            basis, products = np.hstack([basis, added]), np.hstack([products, times(added)])
            size = room
        small = basis.T @ products
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")[: min(width, max(BLOCK, wanted))]
        values, block, product = values[order], basis @ turn[:, order], products @ turn[:, order]
        size = block.shape[1]
        residual = np.linalg.norm(product - block * values, axis=0)[:wanted].max()
        top = max(values[0], 0.0)
        if residual <= CLOSE * top or (residual <= STALLED * top and residual > last / 2):
            return block[:, :wanted]
        last = residual
        # Restarted vectors are made orthogonal again; their products follow.
        block, r = np.linalg.qr(block)
        product = np.linalg.solve(r.T, product.T).T
    raise ArithmeticError("the components did not converge")


def embed(table: FeatureTable) -> DataFrame:
    """The key columns with two principal components of the standardised features.

    A component points where its largest loading (of equal ones the first) is positive,
    so runs agree.
    """
    wells = table.rows.count()
    require(wells >= MIN_WELLS, f"only {wells} wells, {MIN_WELLS} are needed")
    require(len(table.names) >= MIN_FEATURES, "fewer than two usable features")
    scaled = standardise(table).rows
    packed = packed_rows(scaled)
    axes = leading_vectors(lambda q: gram_times(packed, q, 1 / wells), len(table.names)).T
    signs = [1.0 if axis[np.abs(axis).round(9).argmax()] >= 0 else -1.0 for axis in axes]
    keys = [c for c in scaled.columns if c != VECTOR]
    views = [
        dot(F.col(VECTOR), constant_vector((axis * sign).tolist())).alias(f"component_{i + 1}")
        for i, (axis, sign) in enumerate(zip(axes, signs))
    ]
    return scaled.select(*columns(keys), *views)
