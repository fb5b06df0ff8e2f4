"""Work on all pairs of rows in a group without ever listing the pairs.

Rows carry a standardised vector. A group is hashed into blocks of bounded
size and each row is sent to every pair of blocks it takes part in, its cells.
A cell is one task-sized matrix product; what leaves it is a summary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.columns import column, columns
from platewise.operators.joins import join_null_safe
from platewise.session import small_side

# Rows of a group that are one matrix product, and least block size of larger groups.
BLOCK_ROWS = 2048
LARGE_BLOCK_ROWS = 8192
# Each row is copied once per block of its group. Blocks therefore grow with the group, which
# keeps the copies of a row at COPIES, until the vectors of a block take BLOCK_BYTES.
COPIES = 16
BLOCK_BYTES = 32 << 20
CELL = ["__cell_a", "__cell_b"]


def block_count(rows: Column, block_rows: int) -> Column:
    return F.ceil(rows / block_rows).cast("int")


def growing_block_count(rows: Column, block_rows: int, width: int) -> Column:
    """Blocks of a group whose vectors have ``width`` entries, of ``block_rows`` rows or more."""
    held = max(BLOCK_BYTES // (8 * max(width, 1)), 1)
    return F.least(
        block_count(rows, block_rows), F.greatest(F.lit(COPIES), block_count(rows, held))
    )


def to_cells(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], hot: int, row_id: str
) -> DataFrame:
    """Copy each row to the cells of its group; ``groups`` gives ``__blocks`` per key."""
    blocked = join_null_safe(rows, small_side(groups, hot), keys).withColumn(
        "__block", F.pmod(F.xxhash64(column(row_id)), F.col("__blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    return (
        blocked.withColumn("__other", other)
        .withColumn("__cell_a", F.least("__block", "__other"))
        .withColumn("__cell_b", F.greatest("__block", "__other"))
        .drop("__other", "__blocks")
    )


def vectors(cell: pa.Table, name: str) -> np.ndarray:
    """The vector column of a table as a matrix."""
    flat = cell.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(cell.num_rows, -1)


def correlations(
    cell: pa.Table,
    row_id: str,
    name: str,
    slab: int = 512,
    label: str | None = None,
    span: int = LARGE_BLOCK_ROWS,
) -> Iterator[np.ndarray]:
    """Pearson r of the distinct pairs of a cell, a slab of rows by a span of rows at a time.

    With ``label``, a column of numbers, only of the pairs whose numbers differ.

    The rows are put in id order first, so that every reading of the cell
    multiplies the same matrices and gives the same numbers.
    """
    cell = cell.sort_by(row_id)
    block = cell.column("__block").to_numpy()
    z = vectors(cell, name)
    a, b = cell.column("__cell_a")[0].as_py(), cell.column("__cell_b")[0].as_py()
    left, right = z[block == a], z[block == b]
    numbers = cell.column(label).to_numpy() if label else None
    for start in range(0, len(left), slab):
        # Within a block the pairs are those above the diagonal.
        for begin in range(start if a == b else 0, len(right), span):
            r = left[start : start + slab] @ right[begin : begin + span].T / z.shape[1]
            wanted = np.ones(r.shape, dtype=bool)
            if a == b:
                wanted = np.triu(wanted, start - begin + 1)
            if numbers is not None:
                own = numbers[block == a][start : start + slab]
                wanted &= own[:, None] != numbers[block == b][None, begin : begin + span]
            yield r[wanted]


def per_cell(
    cells: DataFrame, keys: Sequence[str], function: Callable[[pa.Table], pa.Table], schema: str
) -> DataFrame:
    return cells.groupBy(*columns(keys), *CELL).applyInArrow(function, schema)
