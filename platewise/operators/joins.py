"""Equi joins whose keys may be null on both sides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from platewise.columns import column


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equally named keys, null matching null, keeping the left keys once."""
    renamed = {key: f"__right_{i}" for i, key in enumerate(keys)}
    other = right.withColumnsRenamed(renamed)
    condition = reduce(
        lambda a, b: a & b, [column(key).eqNullSafe(column(renamed[key])) for key in keys]
    )
    # The broadcast hint sits below the rename and is kept by it.
    return left.join(other, condition, how).drop(*renamed.values())
