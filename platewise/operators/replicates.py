"""Do replicate wells of a compound agree more than wells of different compounds?"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.columns import COMPOUND, CONTROL_COMPOUND, column, columns
from platewise.functions.vectors import dot, let, standardised
from platewise.operators import quantiles as Q
from platewise.operators.features import VECTOR, FeatureTable, require
from platewise.operators.joins import join_null_safe
from platewise.operators.pairs import (
    BLOCK_ROWS,
    LARGE_BLOCK_ROWS,
    correlations,
    growing_block_count,
    per_cell,
    to_cells,
)
from platewise.operators.ranking import with_row_number
from platewise.session import materialize, small_side

# Fixed values of the report.
NULL_PAIRS = 5000
NULL_PERCENTILE = 0.95
HISTOGRAM_EDGES = 40

SCORE = "score"
ZSCORES = "zscores"

# Two multiplicative sequences over a prime field, squared once to break their lattice.
_PRIME = 2_147_483_647
_LEFT, _RIGHT = (48_271, 69_621), (39_373, 16_807)


def row_zscores(table: FeatureTable, keep: Sequence[str]) -> DataFrame:
    """Rows standardised by population deviation, those without variance dropped.

    The dot product of two rows over the number of features is their Pearson r.
    """
    # Exploding the one vector drops the null ones, which a filter would compute twice.
    scaled = let(standardised(F.col(VECTOR)), lambda z: F.when(z.isNotNull(), F.array(z)))
    return table.rows.select(*columns(keep), F.explode(scaled).alias(ZSCORES))


def _width(zscores: DataFrame) -> int:
    """Entries of each vector."""
    found = zscores.select(F.size(ZSCORES).alias("width")).first()
    return found.width if found else 0


def replicate_scores(
    zscores: DataFrame,
    row_id: str,
    compound: str = COMPOUND,
    control: str = CONTROL_COMPOUND,
    *,
    block_rows: int = BLOCK_ROWS,
    large_block_rows: int = LARGE_BLOCK_ROWS,
    max_values: int = Q.MAX_GROUP_ROWS,
) -> DataFrame:
    """Median Pearson r over the pairs of wells of each compound but the control.

    Compounds need two wells. Up to ``block_rows`` wells are one matrix product.
    A larger compound is cut into blocks of ``large_block_rows`` or more, and its median is
    found by counting the correlations per bin in each pair of blocks, then listing those of
    the bin with the wanted rank: two passes of products. ``zscores`` is read once a pass;
    give it materialised.
    """
    wells = F.col("__wells")
    small = wells <= block_rows
    blocks = growing_block_count(wells, large_block_rows, _width(zscores))
    sizes = (
        zscores.where(~column(compound).eqNullSafe(F.lit(control)))
        .groupBy(column(compound))
        .agg(F.count("*").alias("__wells"))
        .where(F.col("__wells") >= 2)
        .withColumn("__blocks", F.when(small, 1).otherwise(blocks))
    )
    sizes = materialize(sizes, "replicates")
    groups, large_groups = sizes.agg(F.count("*"), F.count_if(~small)).first()
    keys = [compound]
    label = zscores.schema[compound].dataType.simpleString()
    schema = f"`{compound}` {label}"

    def cells_of(kept: Column, count: int) -> DataFrame:
        picked = sizes.where(kept).select(column(compound), "__blocks")
        rows = zscores.select(column(compound), column(row_id), ZSCORES)
        return to_cells(rows, picked, keys, count, row_id)

    def median_of_cell(cell: pa.Table) -> pa.Table:
        r = np.concatenate(list(correlations(cell, row_id, ZSCORES)))
        return pa.table({compound: cell.column(compound)[:1], SCORE: [float(np.median(r))]})

    scores = per_cell(
        cells_of(small, groups), keys, median_of_cell, f"{schema}, {SCORE} double"
    )
    if not large_groups:
        return scores

    cells = cells_of(~small, large_groups)
    ranks = sizes.where(~small).select(
        column(compound),
        (wells * (wells - 1) / 2).cast("long").alias("__n"),
        F.lit(-1.001).alias("__lo"),
        F.lit(1.001).alias("__hi"),
    )

    def bracketed(state: DataFrame, hot: int) -> DataFrame:
        return join_null_safe(
            cells, small_side(state.select(column(compound), *Q.BRACKET), hot), keys
        )

    def bounds(cell: pa.Table) -> tuple[float, float]:
        return tuple(cell.column(name)[0].as_py() for name in Q.BRACKET)

    def named(cell: pa.Table, rows: int) -> pa.Array:
        return cell.column(compound).take(pa.array(np.zeros(rows, dtype=np.int64)))

    def count_bins(bins: int) -> Callable[[pa.Table], pa.Table]:
        def count(cell: pa.Table) -> pa.Table:
            lo, hi = bounds(cell)
            found = correlations(cell, row_id, ZSCORES)
            table = _named_bins((r[(r >= lo) & (r <= hi)] for r in found), lo, hi, bins)
            return table.set_column(0, compound, named(cell, table.num_rows))

        return count

    def list_values(cell: pa.Table) -> pa.Table:
        lo, hi = bounds(cell)
        inside = [r[(r >= lo) & (r <= hi)] for r in correlations(cell, row_id, ZSCORES)]
        values, counts = np.unique(np.concatenate([np.empty(0), *inside]), return_counts=True)
        return pa.table(
            {
                compound: named(cell, len(values)),
                Q.VALUE: values,
                Q.COUNT: counts.astype(np.int64),
            }
        )

    def histogram(state: DataFrame, hot: int, first: bool) -> DataFrame:
        binned = per_cell(
            bracketed(state, hot),
            keys,
            count_bins(Q.FINE_BINS if first else Q.BINS),
            f"{schema}, {Q.BIN} int, {Q.COUNT} bigint, {Q.BIN_MIN} double, {Q.BIN_MAX} double",
        )
        return binned.groupBy(column(compound), Q.BIN).agg(
            F.sum(Q.COUNT).alias(Q.COUNT),
            F.min(Q.BIN_MIN).alias(Q.BIN_MIN),
            F.max(Q.BIN_MAX).alias(Q.BIN_MAX),
        )

    def values(state: DataFrame, hot: int) -> DataFrame:
        return per_cell(
            bracketed(state, hot), keys, list_values, f"{schema}, {Q.VALUE} double, {Q.COUNT} bigint"
        )

    large = Q.narrow(Q.start_state(ranks, 0.5), keys, SCORE, histogram, values, max_values)
    return scores.unionAll(large)


def _draw(i: Column, factors: tuple[int, int], n: Column) -> Column:
    """Reproducible draw from 0 to n-1 by plain integer arithmetic."""
    first, second = factors
    spun = (i + 1) * F.lit(first) % F.lit(_PRIME)
    return (spun * spun % F.lit(_PRIME)) * F.lit(second) % F.lit(_PRIME) % n


def null_pairs(
    zscores: DataFrame, row_id: str, compound: str = COMPOUND, pairs: int = NULL_PAIRS
) -> DataFrame:
    """Pearson r of randomly drawn pairs of wells of different compounds.

    Control wells take part. The draws are numbers of rows in ``row_id`` order;
    only the drawn rows are looked up, by joins with the short list of draws.
    """
    numbered = with_row_number(zscores.select(column(row_id)), [], [row_id], "__number")
    rows = zscores.select(column(row_id), column(compound), ZSCORES)
    total = zscores.count()
    i = F.col("id")
    draws = zscores.sparkSession.range(pairs).select(
        i.alias("draw"),
        _draw(i, _LEFT, F.lit(total)).alias("__left"),
        _draw(i, _RIGHT, F.lit(total)).alias("__right"),
    )
    drawn = draws.select("draw", F.posexplode(F.array("__left", "__right")).alias("side", "__number"))
    # `pairs` bounds this side, whatever the size of the cohort.
    wanted = numbered.join(small_side(drawn, 2 * pairs), "__number")
    found = rows.join(small_side(wanted, 2 * pairs), row_id)
    well = F.struct(column(compound).alias("c"), F.col(ZSCORES).alias("z"))
    sides = found.groupBy("draw").agg(
        *[
            F.max(F.when(F.col("side") == s, well)).alias(name)
            for s, name in enumerate(["left", "right"])
        ]
    )
    r = dot(F.col("left.z"), F.col("right.z")) / F.size("left.z")
    return sides.where(~F.col("left.c").eqNullSafe(F.col("right.c"))).select("draw", r.alias("r"))


def null_threshold_all(
    zscores: DataFrame,
    row_id: str,
    compound: str = COMPOUND,
    *,
    percentile: float = NULL_PERCENTILE,
    large_block_rows: int = LARGE_BLOCK_ROWS,
    max_values: int = Q.MAX_GROUP_ROWS,
) -> DataFrame:
    """One row: the percentile of the correlations of all pairs of wells of different compounds.

    Nothing is drawn. Wells are dealt to the cells of a grid of blocks; a cell counts
    its correlations per bin, then lists those of the bin with the wanted rank: two
    passes of products, quadratic in the wells, as all pairs are. ``zscores`` is read
    once a pass; give it materialised.
    """
    counts = zscores.groupBy(column(compound)).agg(F.count("*").alias("n"))
    n = F.col("n")
    wells, pairs = counts.agg(
        F.sum(n), ((F.sum(n) * F.sum(n) - F.sum(n * n)) / 2).cast("long")
    ).first()
    require(bool(pairs), "no two wells of different compounds")
    keys = ["__all"]
    spark = zscores.sparkSession
    blocks = growing_block_count(F.lit(wells), large_block_rows, _width(zscores))
    group = spark.range(1).select(F.lit(0).alias("__all"), blocks.alias("__blocks"))
    rows = zscores.select(
        F.lit(0).alias("__all"),
        column(row_id),
        # Equal labels, null included, have equal numbers.
        F.xxhash64(column(compound)).alias("__label"),
        ZSCORES,
    )
    cells = to_cells(rows, group, keys, 1, row_id)
    start = spark.createDataFrame(
        [(0, pairs, -1.001, 1.001)], "__all int, __n bigint, __lo double, __hi double"
    )

    def bracketed(state: DataFrame, hot: int) -> DataFrame:
        return join_null_safe(cells, small_side(state.select("__all", *Q.BRACKET), hot), keys)

    def inside(cell: pa.Table) -> Iterator[np.ndarray]:
        lo, hi = (cell.column(name)[0].as_py() for name in Q.BRACKET)
        for r in correlations(cell, row_id, ZSCORES, label="__label"):
            yield r[(r >= lo) & (r <= hi)]

    def count_bins(bins: int) -> Callable[[pa.Table], pa.Table]:
        def count(cell: pa.Table) -> pa.Table:
            lo, hi = (cell.column(name)[0].as_py() for name in Q.BRACKET)
            return _named_bins(inside(cell), lo, hi, bins)

        return count

    def list_values(cell: pa.Table) -> pa.Table:
        values, count = np.unique(np.concatenate([np.empty(0), *inside(cell)]), return_counts=True)
        zero = pa.array(np.zeros(len(values)), pa.int32())
        return pa.table({"__all": zero, Q.VALUE: values, Q.COUNT: count.astype(np.int64)})

    def histogram(state: DataFrame, hot: int, first: bool) -> DataFrame:
        schema = f"__all int, {Q.BIN} int, {Q.COUNT} bigint, {Q.BIN_MIN} double, {Q.BIN_MAX} double"
        bins = Q.FINE_BINS if first else Q.BINS
        binned = per_cell(bracketed(state, hot), keys, count_bins(bins), schema)
        return binned.groupBy("__all", Q.BIN).agg(
            F.sum(Q.COUNT).alias(Q.COUNT),
            F.min(Q.BIN_MIN).alias(Q.BIN_MIN),
            F.max(Q.BIN_MAX).alias(Q.BIN_MAX),
        )

    def values(state: DataFrame, hot: int) -> DataFrame:
        schema = f"__all int, {Q.VALUE} double, {Q.COUNT} bigint"
        return per_cell(bracketed(state, hot), keys, list_values, schema)

    state = Q.start_state(start, percentile)
    found = Q.narrow(state, keys, "threshold", histogram, values, max_values)
    return found.select("threshold")


def _named_bins(slabs: Iterator[np.ndarray], lo: float, hi: float, bins: int) -> pa.Table:
    """Counts and ends of the bins between two bounds that hold values."""
    count = np.zeros(bins, dtype=np.int64)
    low, high = np.full(bins, np.inf), np.full(bins, -np.inf)
    for r in slabs:
        place = np.minimum(((r - lo) / (hi - lo) * bins).astype(np.int64), bins - 1)
        count += np.bincount(place, minlength=bins)
        np.minimum.at(low, place, r)
        np.maximum.at(high, place, r)
    used = np.flatnonzero(count)
    return pa.table(
        {
            "__all": pa.array(np.zeros(len(used)), pa.int32()),
            Q.BIN: pa.array(used, pa.int32()),
            Q.COUNT: count[used],
            Q.BIN_MIN: low[used],
            Q.BIN_MAX: high[used],
        }
    )


def null_threshold(null: DataFrame) -> DataFrame:
    """One row: 95th percentile of the null correlations, a sample of fixed size."""
    return null.agg(F.percentile("r", F.lit(NULL_PERCENTILE)).alias("threshold"))


def percent_replicating(scores: DataFrame, threshold: float) -> DataFrame:
    """One row: percentage of compounds scoring strictly above the threshold."""
    above = F.when(F.col(SCORE) > F.lit(float(threshold)), 100.0).otherwise(0.0)
    return scores.agg(F.avg(above).alias("percent_replicating"))


def density_histogram(
    series: DataFrame, name: str = "series", value: str = "value", edges: int = HISTOGRAM_EDGES
) -> DataFrame:
    """Density of each named series over the same equal bins of the joint range."""
    bins = edges - 1
    low, high = series.agg(F.min(value), F.max(value)).first()
    require(low is not None and low < high, "the values have no range")
    width = (high - low) / bins
    number = F.least(F.floor((column(value) - low) / width), F.lit(bins - 1)).cast("int")
    counts = (
        series.where(column(value).isNotNull())
        .groupBy(column(name).alias(name), number.alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    totals = counts.groupBy(name).agg(F.sum("count").alias("total"))
    every = totals.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = every.join(counts, [name, "bin"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0).cast("long"))
    )
    return filled.select(
        name,
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("left_edge"),
        "count",
        (F.col("count") / (F.col("total") * width)).alias("density"),
    )


@dataclass(frozen=True)
class Reproducibility:
    """Replicate scores against the null distribution."""

    scores: DataFrame
    null: DataFrame
    threshold: float
    percent_replicating: float
    histogram: DataFrame


def reproducibility(
    table: FeatureTable,
    row_id: str,
    compound: str = COMPOUND,
    control: str = CONTROL_COMPOUND,
    pairs: int = NULL_PAIRS,
) -> Reproducibility:
    """All results of the replicate report for a cleaned cohort."""
    zscores = materialize(row_zscores(table, [row_id, compound]), "zscores")
    scores = materialize(replicate_scores(zscores, row_id, compound, control), "scores")
    require(not scores.isEmpty(), "no compound has two or more replicate wells")
    null = materialize(null_pairs(zscores, row_id, compound, pairs), "null")
    threshold = null_threshold(null).first().threshold
    require(threshold is not None, "no pair of wells with different compounds")
    both = null.select(F.lit("null").alias("series"), F.col("r").alias("value")).unionAll(
        scores.select(F.lit("replicate"), SCORE)
    )
    return Reproducibility(
        scores,
        null,
        threshold,
        percent_replicating(scores, threshold).first().percent_replicating,
        density_histogram(both),
    )
