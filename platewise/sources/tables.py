"""Text tables written by the segmentation software and by hand."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.columns import SITE, WELL, column
from platewise.operators.index import SOURCE_X, SOURCE_Y
from platewise.session import materialize, small_side

# Fixed value: location files are named <well>-<site>-Nuclei.csv.
LOCATION_GLOB = "*-Nuclei.csv"
LOCATION_NAME_PATTERN = r"^(.*)-([^-]*)-Nuclei\.csv$"
_PATH, _NAMES, _FILE = "__path", "__names", "__file"


def file_headers(spark: SparkSession, path: str | Sequence[str], **options: str) -> DataFrame:
    """Each file with the trimmed names in its first line, which executors read."""
    listed = spark.read.format("binaryFile").options(**options).load(path)

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io

        from pyarrow import fs

        for batch in batches:
            names = []
            for uri in batch[_PATH]:
                files, place = fs.FileSystem.from_uri(uri)
                with files.open_input_stream(place) as opened:
                    line = io.TextIOWrapper(opened, encoding="utf-8-sig", newline="").readline()
                names.append([name.strip() for row in csv.reader([line], skipinitialspace=True) for name in row])
            yield batch.assign(**{_NAMES: names})

    paths = listed.select(F.col("_metadata.file_path").alias(_PATH))
    found = paths.mapInPandas(first_lines, f"{_PATH} string, {_NAMES} array<string>")
    return found.where(F.size(_NAMES) > 0)


def read_by_header(
    spark: SparkSession, path: str | Sequence[str], **options: str
) -> tuple[DataFrame, list[str]]:
    """All rows of text tables whose files may order or choose their columns differently.

    Every file is read by its own header, in one scan: cells come by position and are
    looked up by the position of a name in the header of their file. Returns the
    rows, with the file's name in ``__file``, and the names of the columns; a column
    that a file lacks is null for its rows.
    """
    headers = materialize(file_headers(spark, path, **options), "headers")
    files, width = headers.agg(F.count("*"), F.max(F.size(_NAMES))).first()
    if not files:
        raise FileNotFoundError(f"no table under {path}")
    # One row a column, in the order of the first file that has it.
    named = headers.select(_PATH, F.posexplode(_NAMES).alias("place", "name"))
    first = named.groupBy("name").agg(F.min(F.struct(_PATH, "place")).alias("first"))
    names = [row["name"] for row in first.orderBy("first").collect()]
    cells = [f"c{i}" for i in range(width)]
    rows = (
        spark.read.schema(", ".join(f"{c} string" for c in cells))
        .options(header="true", ignoreLeadingWhiteSpace="true", **options)
        .csv(path)
        .select(
            F.array(*cells).alias("__cells"),
            F.col("_metadata.file_path").alias(_PATH),
            F.col("_metadata.file_name").alias(_FILE),
        )
    )
    joined = rows.join(small_side(headers, files), _PATH)

    def cell(name: str) -> Column:
        place = F.array_position(_NAMES, name)
        return F.when(place > 0, F.get("__cells", (place - 1).cast("int"))).alias(name)

    return joined.select(_FILE, *[cell(name) for name in names]), names


def read_image_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Image tables of one or many files as text columns, header space removed.

    ``path`` is a file, a folder or a pattern. Files may order or choose their
    columns differently; a column that a file lacks is null for its rows.
    """
    rows, names = read_by_header(spark, path, pathGlobFilter="*.csv")
    return rows.select(*[column(name) for name in names])


def read_platemap(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Plate map as trimmed text columns; a byte-order mark is removed.

    Several files may order or choose their columns differently.
    """
    rows, names = read_by_header(spark, path)
    return rows.select(*[F.trim(column(name)).alias(name) for name in names])


def read_locations(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Nuclei centres of a tree of location files with well and site from the names.

    Files may order their columns differently; the two centre columns are read by name.
    """
    rows, names = read_by_header(
        spark, path, pathGlobFilter=LOCATION_GLOB, recursiveFileLookup="true"
    )
    if lacking := {SOURCE_X, SOURCE_Y} - set(names):
        raise ValueError(f"location files have no {' and no '.join(sorted(lacking))}")
    return rows.select(
        F.regexp_extract(_FILE, LOCATION_NAME_PATTERN, 1).alias(WELL),
        F.regexp_extract(_FILE, LOCATION_NAME_PATTERN, 2).alias(SITE),
        column(SOURCE_X).cast("double").alias(SOURCE_X),
        column(SOURCE_Y).cast("double").alias(SOURCE_Y),
    )
