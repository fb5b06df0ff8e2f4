"""Feature cleaning and the vector form of a cohort's profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.columns import array_of, columns, finite, quoted, split_metadata_features
from platewise.functions.vectors import constant_vector
from platewise.operators.quantiles import MAX_GROUP_ROWS, percentile_by_key
from platewise.session import materialize

VECTOR = "features"


class InsufficientData(ValueError):
    """The input cannot support the asked result."""


@dataclass(frozen=True)
class FeatureTable:
    """Rows with a ``features`` vector of the named features beside their key columns."""

    rows: DataFrame
    names: list[str]


def _long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    values = array_of(map(finite, features))
    return df.select(F.posexplode(values).alias("position", "value"))


def _statistics(df: DataFrame, features: Sequence[str]) -> list:
    """Count and range of every feature: one small row each, however long the table."""
    return (
        _long(df, features)
        .groupBy("position")
        .agg(
            F.count("value").alias("present"),
            F.count("*").alias("rows"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .collect()
    )


def clean_features(
    df: DataFrame,
    features: Sequence[str] | None = None,
    *,
    keep: Sequence[str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Finite features only: the ``keep`` columns, then the usable features as double.

    NaN and infinities are missing. Features with fewer than two distinct
    values are dropped, gaps in the others get the feature's exact median. The
    driver sees one row of statistics per feature, never the data.
    """
    metadata, numeric = split_metadata_features(df)
    keep = list(keep) if keep is not None else metadata
    features = list(features) if features is not None else [c for c in numeric if c not in keep]
    if not features:
        return df.selectExpr(*map(quoted, keep))
    seen = sorted(_statistics(df, features), key=lambda s: s.position)
    usable = [s for s in seen if s.present and s.low < s.high]
    gaps = [features[s.position] for s in usable if s.present < s.rows]
    fill = {}
    if gaps:
        medians = percentile_by_key(
            _long(df, gaps), ["position"], "value", 0.5, "median", max_group_rows=max_group_rows
        )
        fill = {gaps[row.position]: row["median"] for row in medians.collect()}

    def filled(name: str) -> str:
        value = finite(name)
        return f"coalesce({value}, double('{fill[name]!r}'))" if name in fill else value

    kept = [features[s.position] for s in usable]
    return df.selectExpr(*map(quoted, keep), *[f"{filled(n)} AS {quoted(n)}" for n in kept])


def feature_table(
    df: DataFrame,
    keep: Sequence[str],
    features: Sequence[str] | None = None,
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> FeatureTable:
    """Cleaned features gathered into one vector per row, written out once for reuse."""
    cleaned = clean_features(df, features, keep=keep, max_group_rows=max_group_rows)
    names = cleaned.columns[len(list(keep)) :]
    vector = array_of(map(quoted, names)).cast("array<double>").alias(VECTOR)
    return FeatureTable(materialize(cleaned.select(*columns(keep), vector), "features"), names)


def standardise(table: FeatureTable) -> FeatureTable:
    """Each feature minus its mean, over its population standard deviation."""
    moments = (
        table.rows.select(F.posexplode(VECTOR).alias("position", "value"))
        .groupBy("position")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
        .orderBy("position")
        .collect()
    )
    # One pair per feature: as wide as the schema, not as long as the data.
    means = constant_vector([m["mean"] for m in moments])
    sds = constant_vector([m.sd or 1.0 for m in moments])
    centred = F.zip_with(VECTOR, means, lambda x, m: x - m)
    scaled = table.rows.withColumn(VECTOR, F.zip_with(centred, sds, lambda x, s: x / s))
    return FeatureTable(scaled, table.names)


def spread(table: FeatureTable) -> DataFrame:
    """The vector back as one column per feature."""
    others = [c for c in table.rows.columns if c != VECTOR]
    return table.rows.selectExpr(
        *map(quoted, others), *[f"{VECTOR}[{i}] AS {quoted(n)}" for i, n in enumerate(table.names)]
    )


def require(condition: bool, message: str) -> None:
    if not condition:
        raise InsufficientData(message)
