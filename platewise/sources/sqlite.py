"""Compartment tables in SQLite files on a file system all executors mount."""

from __future__ import annotations

import math
import sqlite3
from collections.abc import Iterator, Sequence
from contextlib import closing
from functools import reduce
from urllib.parse import unquote, urlsplit
from urllib.request import pathname2url

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.operators.singlecell import COMPARTMENTS, SOURCE
from platewise.operators.union import wider_type

# Bytes of a file that one task reads.
SPLIT_BYTES = 256 * 1024 * 1024
BATCH_ROWS = 10_000
IMAGE_TABLE = "Per_Image"
COMPARTMENT_TABLES = tuple(f"Per_{name}" for name in COMPARTMENTS)


def open_read_only(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{pathname2url(path)}?mode=ro", uri=True)


def sqlite_files(spark: SparkSession, path: str) -> DataFrame:
    """``source`` and ``size`` of the SQLite files under a folder, or of the file given."""
    listed = spark.read.format("binaryFile").options(
        pathGlobFilter="*.sqlite", recursiveFileLookup="true"
    )
    try:
        found = listed.load(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"nothing at {path}") from error
    local = F.udf(lambda uri: unquote(urlsplit(uri).path))
    files = found.select(
        local("_metadata.file_path").alias(SOURCE), F.col("_metadata.file_size").alias("size")
    )
    if files.isEmpty():
        raise FileNotFoundError(f"no SQLite files under {path}")
    return files


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _spark_type(declared: str) -> str:
    """SQLite's affinity rules for a declared type; text, too, for what may hold anything."""
    declared = declared.upper()
    if "INT" in declared:
        return "bigint"
    if any(mark in declared for mark in ("CHAR", "CLOB", "TEXT")):
        return "string"
    if not declared or "BLOB" in declared:
        return "string"
    return "double"


def _column_types(con: sqlite3.Connection, table: str) -> list[tuple[str, str]]:
    """Columns of a table; one without declared type is a number if it holds no text."""
    found = []
    for _, name, declared, *_ in con.execute(f"PRAGMA table_info({_quoted(table)})").fetchall():
        kind = _spark_type(declared or "")
        if not declared:
            other = f"SELECT 1 FROM {_quoted(table)} WHERE typeof({_quoted(name)}) IN ('text', 'blob')"
            kind = "double" if con.execute(f"{other} LIMIT 1").fetchone() is None else "string"
        found.append((name, kind))
    return found


def has_rows(con: sqlite3.Connection, table: str) -> bool:
    """Whether the table exists and holds a row; reads one row at most."""
    try:
        return con.execute(f"SELECT 1 FROM {_quoted(table)} LIMIT 1").fetchone() is not None
    except sqlite3.OperationalError:
        return False


def table_schema(files: DataFrame, table: str) -> T.StructType:
    """Columns that any file's table has, with types that hold all of them; executors look."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch[SOURCE]:
                with closing(open_read_only(path)) as con:
                    columns = enumerate(_column_types(con, table))
                    rows += [(path, i, name, kind) for i, (name, kind) in columns]
            yield pd.DataFrame(rows, columns=["path", "place", "name", "kind"])

    seen = files.select(SOURCE).mapInPandas(look, "path string, place int, name string, kind string")
    merged = seen.groupBy("name").agg(
        F.min(F.struct("path", "place")).alias("first"), F.collect_set("kind").alias("kinds")
    )
    # One row a column.
    columns = merged.orderBy("first").collect()
    if not columns:
        raise ValueError(f"no file has a table {table}")
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    fields = [
        T.StructField(row["name"], reduce(wider_type, [kinds[k] for k in sorted(row["kinds"])]))
        for row in columns
    ]
    return T.StructType([T.StructField(SOURCE, T.StringType()), *fields])


_ARROW = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.StringType(): pa.string()}


def read_share(
    path: str, part: int, parts: int, table: str, schema: T.StructType, needed: Sequence[str] = ()
) -> Iterator[pa.RecordBatch]:
    """Share ``part`` of ``parts`` of a table's row ids in one file."""
    wanted = [f for f in schema if f.name != SOURCE]
    arrow = pa.schema([(f.name, _ARROW[f.dataType]) for f in schema])
    name = _quoted(table)
    with closing(open_read_only(path)) as con:
        present = {row[1] for row in con.execute(f"PRAGMA table_info({name})")}
        if not present or not all(has_rows(con, other) for other in needed):
            return
        low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {name}").fetchone()
        if low is None:
            return
        span = high - low + 1
        begin, end = low + span * part // parts, low + span * (part + 1) // parts
        picked = [_quoted(f.name) if f.name in present else "NULL" for f in wanted]
        rows = con.execute(
            f"SELECT {', '.join(picked)} FROM {name} WHERE rowid >= ? AND rowid < ?", (begin, end)
        )
        while batch := rows.fetchmany(BATCH_ROWS):
            data = [pa.array([path] * len(batch), pa.string())]
            data += [_column(values, f) for values, f in zip(zip(*batch), wanted)]
            yield pa.RecordBatch.from_arrays(data, schema=arrow)


def _column(values: tuple, field: T.StructField) -> pa.Array:
    kind = _ARROW[field.dataType]
    if pa.types.is_string(kind):
        return pa.array([None if v is None else str(v) for v in values], kind)
    return pa.array([_number(v, field.name, pa.types.is_integer(kind)) for v in values], kind)


def _number(value: object, name: str, whole: bool) -> float | int | None:
    """A stored value as the number its column declares; text that is no number raises.

    SQLite may hold anything in any column. Not-a-number is null in whole columns;
    other values that a whole column cannot hold raise rather than be cut.
    """
    if value is None or (isinstance(value, int) and whole):
        return value
    try:
        number = float(value)
    except (TypeError, ValueError):
        raise ValueError(f"column {name} holds {value!r}, which is no number") from None
    if not whole:
        return number
    if math.isnan(number):
        return None
    if not number.is_integer():
        raise ValueError(f"column {name} is declared whole and holds {value!r}")
    return int(number)


def read_sqlite_table(
    spark: SparkSession, path: str, table: str, needed: Sequence[str] = ()
) -> DataFrame:
    """One table of all SQLite files under ``path``, with the file in ``source``.

    Columns are those of any file, null where a file lacks them. Files in which a
    ``needed`` table is absent or empty give no rows. Large files are read in
    several tasks by row-id range.
    """
    files = sqlite_files(spark, path)
    schema = table_schema(files, table)
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / SPLIT_BYTES)).cast("int")
    shares = files.select(SOURCE, parts.alias("parts")).select(
        SOURCE, "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for share in batch.to_pylist():
                yield from read_share(
                    share[SOURCE], share["part"], share["parts"], table, schema, needed
                )

    return shares.repartition(SOURCE, "part").mapInArrow(read, schema)


def source_status(spark: SparkSession, path: str) -> DataFrame:
    """Each SQLite file with ``complete``: whether every compartment has a row.

    The executors open the files and look for one row per table.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name in batch[SOURCE]:
                with closing(open_read_only(name)) as con:
                    found.append(all(has_rows(con, table) for table in COMPARTMENT_TABLES))
            yield batch.assign(complete=found)

    files = sqlite_files(spark, path).select(SOURCE)
    return files.mapInPandas(look, f"{SOURCE} string, complete boolean")


def read_compartments(
    spark: SparkSession, path: str
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Image and compartment tables of the complete sources of a SQLite folder."""

    def read(table: str) -> DataFrame:
        return read_sqlite_table(spark, path, table, COMPARTMENT_TABLES)

    return read(IMAGE_TABLE), {name: read(f"Per_{name}") for name in COMPARTMENTS}
