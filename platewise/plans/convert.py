"""From per-chunk files to one single-cell table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from platewise.columns import METADATA_PREFIX
from platewise.operators.singlecell import (
    FLOAT32,
    SOURCE,
    CompartmentKeys,
    cast_types,
    join_compartments,
)
from platewise.session import materialize
from platewise.sinks.tables import write_lossless, write_parquet
from platewise.sources.embeddings import embedding_width, read_npz, spread_embedding
from platewise.sources.parquet import read_parts
from platewise.sources.sqlite import read_compartments, source_status


@dataclass(frozen=True)
class SourceSplit:
    """Files that gave cells, and files without a row in some compartment."""

    complete: list[str]
    incomplete: list[str]


def convert_compartments(
    spark: SparkSession,
    source: str,
    dest: str,
    keys: CompartmentKeys = CompartmentKeys(),
    cast_map: Mapping[str, str] | None = FLOAT32,
) -> SourceSplit:
    """Join the compartments of SQLite files into a single-cell parquet table.

    Nothing is written when no file is complete.
    """
    status = sorted(source_status(spark, source).collect())
    split = SourceSplit(
        [row[SOURCE] for row in status if row.complete],
        [row[SOURCE] for row in status if not row.complete],
    )
    if split.complete:
        image, tables = read_compartments(spark, source)
        cells = join_compartments(image, tables, keys, skip_incomplete=False)
        write_parquet(cast_types(cells, cast_map), dest)
    return split


def concat_parts(spark: SparkSession, parts: str, dest: str) -> int:
    """Unite all parquet parts under a folder in ``dest``; returns the row count."""
    inside = parts.rstrip("/") + "/"
    if (dest.rstrip("/") + "/").startswith(inside):
        raise ValueError("the destination lies among the parts and would be read again")
    return write_lossless(read_parts(spark, parts), dest)


def convert_embeddings(
    spark: SparkSession,
    source: str,
    dest: str,
    prefix: str = "efficientnet",
    metadata: Mapping[str, str] | None = None,
    **keys: str,
) -> int:
    """Write NPZ embeddings as a single-cell table with one column per value.

    Values keep their type; ``metadata`` maps archive entries to column names. By default
    every entry that any archive has becomes a ``Metadata_`` column, for later grouping.
    """
    cells = materialize(read_npz(spark, source, **keys), "embeddings")
    if metadata is None:
        # One row an entry's name.
        entries = cells.select(F.explode(F.map_keys("metadata")).alias("name")).distinct()
        names = sorted(row["name"] for row in entries.collect())
        metadata = {n: n if n.startswith(METADATA_PREFIX) else METADATA_PREFIX + n for n in names}
    return write_lossless(spread_embedding(cells, embedding_width(cells), prefix, metadata), dest)
