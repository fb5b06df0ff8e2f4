"""Well names such as ``B07`` as grid positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: row letters, then the column number with optional leading zeros.
WELL_PATTERN = r"^\s*([A-Za-z]+)\s*0*([0-9]+)\s*$"
# 13 letters fit a long, and so do 19 digits up to its largest value.
_MOST_LETTERS, _MOST_DIGITS, _LARGEST = 13, 19, 2**63 - 1


def _too_long(what: str) -> Column:
    return F.raise_error(F.lit(f"a well's {what} is beyond the range of a long"))


def letters_to_row(letters: Column) -> Column:
    """Row letters read as a base-26 number from 0: ``A`` 0, ``H`` 7, ``AA`` 26.

    Letters whose number a long cannot hold raise.
    """
    digits = F.transform(F.split(F.upper(letters), ""), lambda c: F.ascii(c) - 64)
    number = F.aggregate(digits, F.lit(0).cast("long"), lambda total, d: total * 26 + d)
    return F.when(F.length(letters) > _MOST_LETTERS, _too_long("row")).otherwise(number - 1)


def _group(well: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(well.cast("string"), WELL_PATTERN, group), F.lit(""))


def well_row(well: Column) -> Column:
    """0-based plate row, null when the name is not a well."""
    return letters_to_row(_group(well, 1))


def well_column(well: Column) -> Column:
    """0-based plate column, null when the name is not a well; a number beyond a long raises."""
    digits = _group(well, 2)
    short = F.when(F.length(digits) <= _MOST_DIGITS, digits).cast("decimal(19,0)")
    fits = digits.isNull() | F.coalesce(short <= F.lit(_LARGEST), F.lit(False))
    return F.when(fits, short.cast("long") - 1).otherwise(_too_long("column"))
