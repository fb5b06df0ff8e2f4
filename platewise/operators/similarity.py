"""Activity against a control and similarity of the most active profiles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.columns import COMPOUND, CONTROL_COMPOUND, column, columns
from platewise.functions.vectors import constant_vector, distance, standardised
from platewise.operators.features import VECTOR, FeatureTable, require
from platewise.operators.pairs import BLOCK_ROWS, block_count, per_cell, to_cells, vectors
from platewise.operators.replicates import ZSCORES
from platewise.session import materialize

ACTIVITY = "activity"
TOP_PROFILES = 50


def control_reference(
    table: FeatureTable, compound: str = COMPOUND, control: str = CONTROL_COMPOUND
) -> list[float]:
    """Mean vector of the control rows, zeros when there are none."""
    means = (
        table.rows.where(column(compound) == control)
        .select(F.posexplode(VECTOR).alias("position", "value"))
        .groupBy("position")
        .agg(F.avg("value").alias("mean"))
        .collect()
    )
    reference = [0.0] * len(table.names)
    for row in means:
        reference[row.position] = row["mean"]
    return reference


def activity(
    table: FeatureTable, compound: str = COMPOUND, control: str = CONTROL_COMPOUND
) -> DataFrame:
    """Each row with its distance to the control; control rows rank below all others."""
    reference = constant_vector(control_reference(table, compound, control))
    measured = distance(F.col(VECTOR), reference)
    return table.rows.withColumn(
        ACTIVITY, F.when(column(compound) == control, F.lit(float("-inf"))).otherwise(measured)
    )


def most_active(
    active: DataFrame, tie_break: Sequence[str], top_n: int = TOP_PROFILES
) -> DataFrame:
    """The ``top_n`` rows by activity, 0 for all; equal ones in ``tie_break`` order."""
    ordered = active.orderBy(F.col(ACTIVITY).desc(), *columns(tie_break))
    return ordered.limit(top_n) if top_n > 0 else ordered


def similarity(
    selected: FeatureTable, row_id: str, *, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Pearson r of every two rows in both orders, null for rows without variance.

    The matrix itself is the result. It is computed in pairs of row blocks, so no
    task holds more than two blocks of vectors.
    """
    total = selected.rows.count()
    require(total >= 2, f"only {total} profiles, two are needed")
    # Rows without variance travel as vectors of nulls; their correlations are null.
    nothing = F.array_repeat(F.lit(None).cast("double"), len(selected.names))
    rows = selected.rows.select(
        F.lit(0).alias("__group"),
        column(row_id),
        F.coalesce(standardised(F.col(VECTOR)), nothing).alias(ZSCORES),
    )
    blocks = rows.sparkSession.range(1).select(
        F.lit(0).alias("__group"), block_count(F.lit(total), block_rows).alias("__blocks")
    )
    cells = to_cells(rows, blocks, ["__group"], 1, row_id)
    kind = selected.rows.schema[row_id].dataType.simpleString()

    def correlate(cell: pa.Table) -> pa.Table:
        a, b = cell.column("__cell_a")[0].as_py(), cell.column("__cell_b")[0].as_py()
        block = cell.column("__block").to_numpy()
        z = vectors(cell, ZSCORES)
        left, right = (block == a).nonzero()[0], (block == b).nonzero()[0]
        r = (z[left] @ z[right].T / z.shape[1]).ravel()
        names = cell.column(row_id)
        first = names.take(pa.array(np.repeat(left, len(right))))
        second = names.take(pa.array(np.tile(right, len(left))))
        value = pa.array(r, from_pandas=True)
        if a == b:
            return pa.table({"left": first, "right": second, "r": value})
        return pa.table(
            {
                "left": pa.chunked_array([*first.chunks, *second.chunks]),
                "right": pa.chunked_array([*second.chunks, *first.chunks]),
                "r": pa.chunked_array([value, value]),
            }
        )

    return per_cell(cells, ["__group"], correlate, f"left {kind}, right {kind}, r double")


def compound_similarity(
    table: FeatureTable,
    row_id: str = COMPOUND,
    compound: str = COMPOUND,
    control: str = CONTROL_COMPOUND,
    top_n: int = TOP_PROFILES,
) -> DataFrame:
    """Correlations among the most active profiles of a cleaned consensus table."""
    chosen = most_active(activity(table, compound, control), [row_id], top_n)
    return similarity(FeatureTable(materialize(chosen, "selected"), table.names), row_id)
