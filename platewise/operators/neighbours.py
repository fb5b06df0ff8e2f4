"""Profiles that correlate, without the matrix of all correlations.

Standardised profiles are points of a sphere, and Pearson r is the cosine of the angle
between two. Points go to the nearest of some pivots; a pivot's cap, the widest angle to
its points, bounds every r with the points of another. Pairs of caps that cannot reach
what is asked are never multiplied, and of the others only the asked pairs leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.columns import column
from platewise.functions.vectors import standardised
from platewise.operators.features import VECTOR, FeatureTable
from platewise.operators.pairs import BLOCK_ROWS, CELL, per_cell, vectors
from platewise.operators.replicates import ZSCORES
from platewise.session import materialize

# Rows of the sample that pivots and first bounds come from, and pivots.
SAMPLE_ROWS, PIVOTS = 2048, 64
# Correlations are told apart to so many decimals; bounds leave room for more rounding.
DECIMALS, ROOM = 12, 1e-9
_CAP, _PART = "__cap", "__part"


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pa.table({"z": column})
    z = vectors(flat, "z")
    return z / np.sqrt(z.shape[1])


def _spread(points: np.ndarray, size: int) -> np.ndarray:
    """Points of the sample that lie far apart: the one least like those chosen, again and again."""
    chosen = [0]
    likeness = points @ points[0]
    while len(chosen) < min(size, len(points)) and likeness.min() < 1 - 1e-12:
        chosen.append(int(likeness.argmin()))
        likeness = np.maximum(likeness, points @ points[chosen[-1]])
    return points[chosen]


def _search(table: FeatureTable, row_id: str, k: int | None, least: float | None, block_rows: int) -> DataFrame:
    kind = table.rows.schema[row_id].dataType.simpleString()
    scaled = table.rows.select(column(row_id).alias("__id"), standardised(F.col(VECTOR)).alias(ZSCORES))
    rows = materialize(scaled.where(F.col(ZSCORES).isNotNull() & F.col("__id").isNotNull()), "standardised")
    out = f"`left` {kind}, `right` {kind}, r double"
    sample = rows.orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE_ROWS).toArrow()
    if not sample.num_rows:
        return rows.sparkSession.createDataFrame([], out)
    known_ids, known = sample.column("__id").combine_chunks(), _unit(sample.column(ZSCORES))
    pivots = _spread(known, PIVOTS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _unit(batch.column(1))
            near = points @ pivots.T
            cap = near.argmax(axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(cap)), cap], -1, 1))
            floor = np.full(len(cap), -np.inf if least is None else least)
            if k is not None and len(known) > k:
                # A row may be among the sample itself: one more than k are counted then.
                floor = -np.partition(-(points @ known.T), k, axis=1)[:, k] - ROOM
            columns = [batch.column(0), batch.column(1), pa.array(cap, pa.int32()), pa.array(angle), pa.array(floor)]
            yield pa.RecordBatch.from_arrays(columns, names=["__id", ZSCORES, _CAP, "angle", "floor"])

    schema = f"`__id` {kind}, {ZSCORES} array<double>, {_CAP} int, angle double, floor double"
    placed = materialize(rows.mapInArrow(place, schema), "placed")
    # One row a pivot.
    caps = placed.groupBy(_CAP).agg(F.count("*").alias("n"), F.max("angle").alias("angle"), F.min("floor").alias("floor")).collect()
    between = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    asked = []
    for a in caps:
        for b in caps:
            if a[_CAP] <= b[_CAP]:
                nearest = max(0.0, between[a[_CAP], b[_CAP]] - a.angle - b.angle)
                if np.cos(nearest) + ROOM >= min(a.floor, b.floor):
                    asked.append((a[_CAP], b[_CAP]))
    spark = rows.sparkSession
    parts = {c[_CAP]: -(-c.n // block_rows) for c in caps}
    # A cap of many rows is several blocks; each pair of blocks of an asked pair of caps is a cell.
    pairs = spark.createDataFrame([(a, b, parts[a], parts[b]) for a, b in asked], "a int, b int, p int, q int")
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("p") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("q") - 1))).where("a < b OR i <= j")
    # A block's number has its cap in the upper half.
    number = lambda cap, part: F.shiftleft(F.col(cap).cast("long"), 32) + F.col(part)
    cells = pairs.select(number("a", "i").alias(CELL[0]), number("b", "j").alias(CELL[1]))
    ends = cells.select("*", F.explode(F.array_distinct(F.array(*CELL))).alias("__block"))
    sizes = F.create_map(*[F.lit(x) for item in parts.items() for x in item])
    part = F.pmod(F.xxhash64("__id"), F.try_element_at(sizes, F.col(_CAP)).cast("long"))
    dealt = placed.withColumn(_PART, part).select("__id", ZSCORES, "floor", number(_CAP, _PART).alias("__block"))
    copied = dealt.join(ends, "__block")

    def correlate(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("__id")
        a, b = cell.column(CELL[0])[0].as_py(), cell.column(CELL[1])[0].as_py()
        block, points = cell.column("__block").to_numpy(), _unit(cell.column(ZSCORES))
        floors, ids = cell.column("floor").to_numpy(), cell.column("__id").combine_chunks()
        lefts, rights, values = [], [], []

        def take(rows: np.ndarray, others: np.ndarray) -> None:
            for begin in range(0, len(rows), 512):
                some = rows[begin : begin + 512]
                r = np.round(points[some] @ points[others].T, DECIMALS)
                # Not the row itself; repeated rows of one id count as others.
                wanted = (r >= floors[some][:, None] - ROOM) & (some[:, None] != others[None, :])
                for i, row in enumerate(some):
                    found = np.flatnonzero(wanted[i])
                    if k is not None and len(found) > k:
                        # Rows are in id order, so a stable sort gives ties to the smaller id.
                        found = found[np.argsort(-r[i, found], kind="stable")[:k]]
                    lefts.append(np.full(len(found), row))
                    rights.append(others[found])
                    values.append(r[i, found])

        first, second = np.flatnonzero(block == a), np.flatnonzero(block == b)
        take(first, second)
        if a != b:
            take(second, first)
        left, right = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (lefts, rights))
        return pa.table({"left": ids.take(pa.array(left)), "right": ids.take(pa.array(right)), "r": np.concatenate([np.zeros(0), *values])})

    return per_cell(copied, [], correlate, out)


def similar_profiles(table: FeatureTable, row_id: str, least_r: float, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``left``, ``right`` and ``r`` of every two rows, in both orders, whose r is at least ``least_r``.

    r is rounded to ``DECIMALS``. Rows without variance or id have no r. As many rows come
    out as pairs are asked for: copies of one profile are all similar to each other.
    """
    found = _search(table, row_id, None, float(least_r), block_rows)
    return found.where(F.col("r") >= float(least_r))


def nearest_profiles(table: FeatureTable, row_id: str, k: int, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``left``, ``rank`` from 1, ``right`` and ``r``: the ``k`` rows that correlate best with each row.

    Equal r, rounded to ``DECIMALS``, go to the smaller id; a row with fewer others gets
    all of them. Rows without variance or id take no part. At most ``k`` rows a row and
    block leave a task, so the output grows with the rows, not their pairs.
    """
    if k < 1:
        raise ValueError("k must be positive")
    order = Window.partitionBy("left").orderBy(F.desc("r"), "right")
    ranked = _search(table, row_id, k, None, block_rows).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("left", "rank", "right", "r")
