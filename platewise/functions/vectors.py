"""Expressions on feature vectors held as ``array<double>``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZERO = 0.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Inside an array function's lambda Spark would compute it per element.
    """
    return F.transform(F.array(value), body)[0]


def constant_vector(values: Sequence[float]) -> Column:
    """A vector that is the same for every row."""
    return F.expr("array(" + ", ".join(f"double('{v!r}')" for v in values) + ")").cast(
        "array<double>"
    )


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(_ZERO), lambda acc, x: acc + x)


def mean(vector: Column) -> Column:
    return total(vector) / F.size(vector)


def mean_absolute(vector: Column) -> Column:
    """Mean of absolute values, skipping null and NaN; null when nothing is left."""
    sizes = F.transform(
        F.filter(vector, lambda x: x.isNotNull() & ~F.isnan(x)), lambda x: F.abs(x)
    )
    return let(sizes, lambda s: F.when(F.size(s) > 0, mean(s)))


def centred(vector: Column) -> Column:
    """The values minus their mean."""
    return let(mean(vector), lambda m: F.transform(vector, lambda x: x - m))


def standardised(vector: Column) -> Column:
    """Centred values over their population deviation, null where that is 0."""

    def scaled(c: Column) -> Column:
        deviation = norm(c) / F.sqrt(F.size(c))
        return let(deviation, lambda s: F.when(s > 0, F.transform(c, lambda x: x / s)))

    return let(centred(vector), scaled)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(_ZERO), lambda acc, x: acc + x * x))


def distance(left: Column, right: Column) -> Column:
    """Euclidean distance."""
    return norm(F.zip_with(left, right, lambda a, b: a - b))


def dot(left: Column, right: Column) -> Column:
    return total(F.zip_with(left, right, lambda a, b: a * b))
