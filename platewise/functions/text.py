"""Small string expressions on file names and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(path: Column) -> Column:
    """Last component of a path."""
    return F.substring_index(path, "/", -1)


def path_order(path: Column) -> Column:
    """Sort key that compares paths component by component.

    The separator becomes a character below all printable ones, so that a folder sorts before
    longer names that begin alike.
    """
    return F.translate(path, "/", "\x01")


def replace_extension(name: Column, extension: str) -> Column:
    """Swap what follows the last dot; names without a dot get the extension."""
    return F.concat(F.regexp_replace(name, r"\.[^.]*$", ""), F.lit(extension))


def plate_from_file_name(name: Column) -> Column:
    """Plate id of a profile file: its name up to the first dot."""
    return F.substring_index(name, ".", 1)


def joined_key(parts: list[Column]) -> Column:
    return F.concat_ws("/", *parts)
