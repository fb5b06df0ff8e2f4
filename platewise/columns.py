"""Column-name contract of profile tables.

``Metadata_*`` columns describe a row, everything else that is numeric is a
measured feature.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the file formats this library reads and writes.
METADATA_PREFIX = "Metadata_"
PLATE = "Metadata_Plate"
WELL = "Metadata_Well"
SITE = "Metadata_Site"
COMPOUND = "Metadata_Compound"
BATCH = "Metadata_Batch"
CONTROL_COMPOUND = "DMSO"
COMPARTMENT_PREFIXES = ("Cells", "Nuclei", "Cytoplasm")
WELL_COLUMN_CANDIDATES = (WELL, "Image_Metadata_Well")

# Decimals are not features: the profile format only knows binary numbers.
_FEATURE_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
)


def column(name: str) -> Column:
    """Reference a column by its exact name, also when it holds dots."""
    return F.col(quoted(name))


def columns(names: Iterable[str]) -> list[Column]:
    return [column(name) for name in names]


def quoted(name: str) -> str:
    """A column name in SQL text.

    Expressions over thousands of columns are built as text: one call to the
    JVM instead of several per column.
    """
    return "`" + name.replace("`", "``") + "`"


def measured(name: str) -> str:
    """SQL: the column as double with NaN turned into null, so that aggregates skip it."""
    return f"nanvl(CAST({quoted(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def finite(name: str) -> str:
    """SQL: the column as double; NaN, infinities and what is no number become null."""
    value = f"try_cast({quoted(name)} AS DOUBLE)"
    return f"CASE WHEN abs({value}) < double('Infinity') THEN {value} END"


def array_of(expressions: Iterable[str]) -> Column:
    """Array of SQL expressions."""
    return F.expr(f"array({', '.join(expressions)})")


def infer_features(names: Sequence[str]) -> list[str]:
    """Feature columns of a segmented single-cell table, by compartment prefix."""
    found = [name for name in names if name.startswith(COMPARTMENT_PREFIXES)]
    if not found:
        raise ValueError(
            "no feature column starts with any of "
            f"{', '.join(COMPARTMENT_PREFIXES)}; name the features explicitly"
        )
    return found


def split_metadata_features(df: DataFrame) -> tuple[list[str], list[str]]:
    """Names of the metadata columns and of the numeric feature columns."""
    metadata = [f.name for f in df.schema if f.name.startswith(METADATA_PREFIX)]
    features = [
        f.name
        for f in df.schema
        if not f.name.startswith(METADATA_PREFIX) and isinstance(f.dataType, _FEATURE_TYPES)
    ]
    return metadata, features


def require_columns(df: DataFrame, names: Iterable[str], error: type[Exception] = ValueError) -> None:
    """Raise unless every name is a column; names are compared case-sensitively."""
    present = set(df.columns)
    missing = [name for name in names if name not in present]
    if missing:
        raise error(f"columns not present: {', '.join(missing)}")


def detect_well_column(names: Sequence[str]) -> str:
    """The well column; of several known names the first in the list of candidates."""
    known = [name for name in WELL_COLUMN_CANDIDATES if name in set(names)]
    if not known:
        raise KeyError(f"the well column is called none of {' or '.join(WELL_COLUMN_CANDIDATES)}")
    return known[0]
