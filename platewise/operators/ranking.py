"""Row numbers that do not need all rows of a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.columns import column, columns
from platewise.operators.joins import join_null_safe
from platewise.session import materialize

_PART, _SHIFT = "__part", "__shift"


def with_row_number(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], alias: str
) -> DataFrame:
    """Add the 0-based position of each row in its group's order, nulls last.

    The rows are range partitioned by group and order, so a large group spreads
    over many partitions. Each partition numbers its own rows and adds how many
    rows of the group lie in earlier partitions. The ranged rows are written
    out once: their partition ids must not change between the two readings.
    """
    sort = [column(c).asc_nulls_last() for c in order_by]
    group = columns(partition_by)
    ranged = materialize(
        df.repartitionByRange(*[c.asc_nulls_last() for c in group], *sort).withColumn(
            _PART, F.spark_partition_id()
        ),
        "ranged",
    )
    # One row per group and partition it touches.
    counts = ranged.groupBy(*group, _PART).agg(F.count("*").alias(_SHIFT))
    earlier = Window.partitionBy(*group or [F.lit(0)]).orderBy(_PART)
    shifts = counts.withColumn(_SHIFT, F.sum(_SHIFT).over(earlier) - F.col(_SHIFT))
    within = Window.partitionBy(*group, _PART).orderBy(*sort)
    return (
        join_null_safe(ranged, shifts, [*partition_by, _PART])
        .withColumn(alias, F.row_number().over(within) - 1 + F.col(_SHIFT))
        .drop(_PART, _SHIFT)
    )


def with_chunk_number(
    df: DataFrame,
    size: int,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    alias: str = "chunk",
) -> DataFrame:
    """Cut each group into consecutive chunks of ``size`` rows, numbered from 1."""
    if size < 1:
        raise ValueError("chunk size must be positive")
    ranked = with_row_number(df, partition_by, order_by, "__rank")
    return ranked.withColumn(alias, F.floor(F.col("__rank") / size) + 1).drop("__rank")


def category_ranks(df: DataFrame, label: str, alias: str = "rank") -> DataFrame:
    """The distinct labels with their 0-based position in sorted order."""
    return with_row_number(df.select(column(label)).distinct(), [], [label], alias)


def with_category_rank(df: DataFrame, label: str, alias: str = "rank") -> DataFrame:
    """Add to each row the rank of its label among the sorted distinct labels."""
    return join_null_safe(df, category_ranks(df, label, alias), [label], "left")
