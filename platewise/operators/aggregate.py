"""Well-level profiles: the exact median of every feature per group.

The rows are turned into blocks of features before they are grouped. A group's
buffer then holds one block instead of thousands of features, the work of one
group spreads over its blocks, and the plan stays small however wide the table
is. Groups with very many rows are read twice, see ``quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.columns import (
    array_of,
    column,
    columns,
    infer_features,
    measured,
    quoted,
    require_columns,
)
from platewise.operators.joins import join_null_safe
from platewise.operators.quantiles import MAX_GROUP_ROWS, percentile_of_large_keys
from platewise.session import settled, small_side

# Blocks of 32, 64 and 128 take the same time; the smallest has the smallest buffers.
BLOCK_FEATURES = 32


def resolve_features(
    df: DataFrame, strata: Sequence[str], features: Sequence[str] | None
) -> list[str]:
    """The features to aggregate, checked; ``None`` infers them by prefix."""
    if not strata:
        raise ValueError("strata must name at least one grouping column")
    if features is None:
        features = infer_features(df.columns)
    elif not features:
        raise ValueError("features must not be empty; pass None to infer them")
    require_columns(df, [*strata, *features])
    return list(features)


def strata_order(strata: Sequence[str]) -> list[Column]:
    """The order of groups: by their keys, nulls last."""
    return [column(s).asc_nulls_last() for s in strata]


def _median_in_blocks(df: DataFrame, strata: Sequence[str], features: Sequence[str]) -> DataFrame:
    if len(features) <= BLOCK_FEATURES:
        medians = [F.expr(f"median({measured(name)}) AS {quoted(name)}") for name in features]
        return df.groupBy(*columns(strata)).agg(*medians)

    starts = range(0, len(features), BLOCK_FEATURES)
    padding = ["CAST(NULL AS DOUBLE)"] * (-len(features) % BLOCK_FEATURES)
    cells = [measured(name) for name in features] + padding
    blocks = array_of(f"array({', '.join(cells[s : s + BLOCK_FEATURES])})" for s in starts)
    keys = {name: f"__key_{i}" for i, name in enumerate(strata)}
    exploded = df.select(
        *[column(name).alias(key) for name, key in keys.items()],
        F.posexplode(blocks).alias("__block", "__values"),
    )
    medians = array_of(f"median(__values[{i}])" for i in range(BLOCK_FEATURES))
    per_block = exploded.groupBy(*keys.values(), "__block").agg(medians.alias("__medians"))
    gathered = per_block.groupBy(*keys.values()).agg(
        F.sort_array(F.collect_list(F.struct("__block", "__medians"))).alias("__blocks")
    )
    flat = gathered.withColumn("__flat", F.flatten(F.col("__blocks.__medians")))
    return flat.selectExpr(
        *[f"{key} AS {quoted(name)}" for name, key in keys.items()],
        *[f"__flat[{i}] AS {quoted(name)}" for i, name in enumerate(features)],
    )


def _median_of_large_groups(
    df: DataFrame, strata: Sequence[str], features: Sequence[str], max_group_rows: int
) -> DataFrame:
    keys = {name: f"__key_{i}" for i, name in enumerate(strata)}
    long = df.select(
        *[column(name).alias(key) for name, key in keys.items()],
        F.posexplode(array_of(map(measured, features))).alias("__feature", "__x"),
    )
    medians = percentile_of_large_keys(
        long, [*keys.values(), "__feature"], "__x", 0.5, "__median", max_group_rows=max_group_rows
    )
    wide = (
        medians.groupBy(*keys.values())
        .pivot("__feature", list(range(len(features))))
        .agg(F.first("__median"))
    )
    return wide.selectExpr(
        *[f"{key} AS {quoted(name)}" for name, key in keys.items()],
        *[f"`{i}` AS {quoted(name)}" for i, name in enumerate(features)],
    )


def aggregate_median(
    df: DataFrame,
    strata: Sequence[str],
    features: Sequence[str] | None = None,
    *,
    ordered: bool = True,
    max_group_rows: int | None = None,
) -> DataFrame:
    """One row per group with the exact median of every feature, as double.

    NaN and null are skipped, infinities count as values, a null key is a group
    of its own and the groups come ordered with nulls last. Reads the key
    columns once beforehand to find groups above ``max_group_rows``, by default
    as many rows as fill a buffer with one block of features.
    """
    features = resolve_features(df, strata, features)
    if max_group_rows is None:
        max_group_rows = MAX_GROUP_ROWS // min(len(features), BLOCK_FEATURES)
    sizes = df.groupBy(*columns(strata)).agg(F.count("*").alias("__rows"))
    large = sizes.where(F.col("__rows") > max_group_rows).select(*columns(strata))
    hot, hot_groups = settled(large, "hot-groups")
    if hot_groups:
        side = small_side(hot, hot_groups)
        large = join_null_safe(df, side, strata, "left_semi")
        rest = join_null_safe(df, side, strata, "left_anti")
        result = _median_in_blocks(rest, strata, features).unionAll(
            _median_of_large_groups(large, strata, features, max_group_rows)
        )
    else:
        result = _median_in_blocks(df, strata, features)
    return result.orderBy(*strata_order(strata)) if ordered else result
