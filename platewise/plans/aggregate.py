"""From a single-cell table to well-level profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from platewise.operators.aggregate import aggregate_median, strata_order
from platewise.sinks.ordered import write_in_order


def aggregate(
    spark: SparkSession,
    source: str,
    dest: str,
    *,
    strata: Sequence[str],
    features: Sequence[str] | None = None,
) -> str:
    """Write the exact medians of a single-cell parquet table per group, ordered by the strata.

    ``sinks.ordered.read_in_order`` gives the rows their place in that order.
    """
    medians = aggregate_median(spark.read.parquet(source), strata, features, ordered=False)
    return write_in_order(medians, dest, strata_order(strata))
