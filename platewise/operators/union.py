"""Unions by column name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from platewise.columns import quoted

# Numbers from narrow to wide, and the decimal digits an integer may need.
_NUMBERS = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.FloatType,
    T.DoubleType,
)
_DIGITS = {T.BooleanType: 1, T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def leaf_names(kind: T.DataType, name: str = "") -> set[str]:
    """Names of the leaf columns of a schema; nested fields give their own names."""
    if isinstance(kind, T.StructType):
        return {leaf for f in kind for leaf in leaf_names(f.dataType, f.name)}
    if isinstance(kind, T.ArrayType):
        return leaf_names(kind.elementType, "element")
    if isinstance(kind, T.MapType):
        return leaf_names(kind.keyType, "key") | leaf_names(kind.valueType, "value")
    return {name}


def require_same_leaves(schemas: Mapping[str, T.StructType]) -> None:
    """Raise unless all named schemas have one set of leaf columns, in any order."""
    leaves = {part: leaf_names(schema) for part, schema in schemas.items()}
    everywhere, anywhere = set.intersection(*leaves.values()), set.union(*leaves.values())
    if everywhere != anywhere:
        owners = {
            name: [part for part, found in leaves.items() if name in found]
            for name in sorted(anywhere - everywhere)
        }
        raise ValueError(f"columns that only some of {len(leaves)} parts have: {owners}")


def _as_decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_DIGITS[type(kind)], 0)


def _wider_number(left: T.DataType, right: T.DataType) -> T.DataType:
    widest = max(left, right, key=lambda t: _NUMBERS.index(type(t)))
    if not isinstance(widest, T.DecimalType):
        return widest
    a, b = _as_decimal(left), _as_decimal(right)
    scale = max(a.scale, b.scale)
    whole = max(a.precision - a.scale, b.precision - b.scale)
    return T.DecimalType(min(whole + scale, 38), scale)


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type that takes both: the wider number or time, text for anything else."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    pair = (left, right)
    if all(isinstance(t, _NUMBERS) for t in pair):
        return _wider_number(left, right)
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in pair):
        return T.TimestampType()
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in pair):
        raise ValueError(f"no common type for {left.simpleString()} and {right.simpleString()}")
    return T.StringType()


def _fields(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema}


def common_types(schemas: Sequence[T.StructType]) -> dict[str, T.DataType]:
    """Column to widened type, in the order of the first schema."""
    found = [_fields(schema) for schema in schemas]
    return {
        name: reduce(wider_type, [fields[name] for fields in found])
        for name in found[0]
    }


def strict_union(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Union all of parts with one column set; orders and types may differ."""
    if not parts:
        raise FileNotFoundError("no parts to unite")
    schemas = {name: df.schema for name, df in parts.items()}
    require_same_leaves(schemas)
    types = common_types(list(schemas.values()))
    aligned = [
        df.selectExpr(
            *[f"CAST({quoted(n)} AS {kind.simpleString()}) AS {quoted(n)}" for n, kind in types.items()]
        )
        for df in parts.values()
    ]
    return reduce(DataFrame.unionAll, aligned)


def loose_union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; a column that a part lacks is null there.

    Columns come in the order of their first appearance. Types that differ between
    parts are widened as ``wider_type`` says, to text where nothing else takes both.
    """
    if not parts:
        raise FileNotFoundError("no profiles to unite")
    found = [_fields(part.schema) for part in parts]
    kinds: dict[str, T.DataType] = {}
    for name, kind in (pair for fields in found for pair in fields.items()):
        kinds[name] = wider_type(kinds[name], kind) if name in kinds else kind
    aligned = []
    for part, fields in zip(parts, found):
        values = {name: quoted(name) if name in fields else "NULL" for name in kinds}
        casts = [
            f"CAST({values[name]} AS {kind.simpleString()}) AS {quoted(name)}"
            for name, kind in kinds.items()
        ]
        aligned.append(part.selectExpr(*casts))
    return reduce(DataFrame.unionAll, aligned)
