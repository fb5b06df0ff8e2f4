"""Parquet parts and profile files."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from platewise.columns import PLATE, column, quoted
from platewise.functions.text import plate_from_file_name
from platewise.operators.union import require_same_leaves, wider_type
from platewise.session import materialize, settled, small_side

# Rows of a part that a task holds at once where it reads parts by itself.
BATCH_ROWS = 4096
_PART, _GROUP = "__part", "__group"


def parquet_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a parquet file; no rows are read."""
    return spark.read.parquet(path).columns


def _listing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    listed = spark.read.format("binaryFile").options(
        pathGlobFilter="*.parquet", recursiveFileLookup="true"
    )
    return listed.load([paths] if isinstance(paths, str) else list(paths)).select("path")


def find_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of all parquet files under a folder; their content is not read."""
    return _listing(spark, folder)


def _located(path: str):
    """File system and name of a listed path, which is not escaped as an address is."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(quote(path, safe="/:@"))


def part_footers(parts: DataFrame) -> DataFrame:
    """Each part with its schema and its number of row groups, which executors read from the footer.

    ``fields`` is JSON text: column names and their types, in the part's order.
    """

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet as pq

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                files, name = _located(path)
                with files.open_input_file(name) as opened:
                    footer = pq.ParquetFile(opened)
                    kinds = {f.name: _kind(f.type) for f in footer.schema_arrow}
                    # The oldest encoding of timestamps has no zone in its name but means UTC.
                    for i in range(len(footer.schema)):
                        leaf = footer.schema.column(i)
                        if leaf.physical_type == "INT96" and leaf.path in kinds:
                            kinds[leaf.path] = T.TimestampType()
                    groups = footer.metadata.num_row_groups
                rows.append((path, json.dumps({n: k.jsonValue() for n, k in kinds.items()}), groups))
            columns = [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "fields", "groups"])

    return parts.mapInArrow(footers, "path string, fields string, groups int")


def _kind(kind: pa.DataType) -> T.DataType:
    """The type as which Spark reads a column of this Arrow type."""
    if pa.types.is_dictionary(kind):
        return _kind(kind.value_type)
    if pa.types.is_unsigned_integer(kind):
        return {8: T.ShortType(), 16: T.IntegerType(), 32: T.LongType(), 64: T.DecimalType(20, 0)}[kind.bit_width]
    if pa.types.is_timestamp(kind):
        return T.TimestampType() if kind.tz else T.TimestampNTZType()
    if pa.types.is_struct(kind):
        return T.StructType([T.StructField(f.name, _kind(f.type)) for f in kind])
    if pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind):
        return T.ArrayType(_kind(kind.value_type))
    return from_arrow_type(kind)


def _schema(fields: str) -> T.StructType:
    return T.StructType([T.StructField(n, _type(k)) for n, k in json.loads(fields).items()])


def _type(value: str | dict) -> T.DataType:
    return T._parse_datatype_json_value(value)


def distinct_layouts(footers: DataFrame) -> list[T.StructType]:
    """The distinct schemas of the parts, by their first part: one row a layout, not a part."""
    found = footers.groupBy("fields").agg(F.min("path").alias("example")).collect()
    return [_schema(row.fields) for row in sorted(found, key=lambda row: row.example)]


# What the parquet reader itself turns into a wider type.
_PROMOTED = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


def _promotes(kind: T.DataType, target: T.DataType) -> bool:
    return kind == target or isinstance(target, _PROMOTED.get(type(kind), ()))


def _file(path: Column) -> Column:
    """One spelling of a file's address, which the reader escapes and a listing does not."""
    plain = F.regexp_replace(path, r"^([a-z0-9]+):/+", "$1:/")
    return F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))


def read_united(
    spark: SparkSession, paths: str | Sequence[str], footers: DataFrame, kinds: Mapping[str, T.DataType]
) -> DataFrame:
    """All parts as one table of the given columns and types, with their address in ``__part``.

    One scan reads all parts where its reader can widen every column; a column that a
    part lacks is null there. Where a column is, say, a number in one part and text in
    another, executors read the parts row group by row group, each type in a column of
    its own, and Spark casts these to the common type. Either way nothing lists the parts
    on the driver, and the number of scans does not depend on how many layouts there are.
    """
    layouts = distinct_layouts(footers)
    if all(_promotes(f.dataType, kinds[f.name]) for layout in layouts for f in layout):
        schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])
        reader = spark.read.schema(schema).options(pathGlobFilter="*.parquet", recursiveFileLookup="true")
        found = reader.parquet(*([paths] if isinstance(paths, str) else paths))
        return found.select(*[column(n) for n in kinds], _file(F.col("_metadata.file_path")).alias(_PART))
    lanes: dict[tuple[str, str], T.DataType] = {}
    for layout in layouts:
        for f in layout:
            lanes[f.name, f.dataType.simpleString()] = f.dataType
    names = {key: f"lane_{i}" for i, key in enumerate(lanes)}
    out = T.StructType([T.StructField(_PART, T.StringType())] + [T.StructField(names[k], t) for k, t in lanes.items()])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            for path, fields, group in zip(*[c.to_pylist() for c in batch.columns]):
                files, name = _located(path)
                with files.open_input_file(name) as opened:
                    part = pq.ParquetFile(opened)
                    held = {names[n, _type(k).simpleString()]: n for n, k in json.loads(fields).items()}
                    for rows in part.iter_batches(BATCH_ROWS, row_groups=[group]):
                        size = rows.num_rows
                        values = [
                            pa.array([path] * size) if f.name == _PART
                            else rows.column(held[f.name]).cast(f.type) if f.name in held
                            else pa.nulls(size, f.type)
                            for f in arrow
                        ]
                        yield pa.RecordBatch.from_arrays(values, schema=arrow)

    groups = footers.filter("groups > 0").select("path", "fields", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias(_GROUP))
    # One row a row group: spread over all tasks before these are read.
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    raw = groups.repartition(tasks, "path", _GROUP).mapInArrow(read, out)

    def united(name: str, kind: T.DataType) -> str:
        held = [f"CAST({names[key]} AS {kind.simpleString()})" for key in lanes if key[0] == name]
        return f"coalesce({', '.join(held)}) AS {quoted(name)}"

    return raw.select(*[F.expr(united(n, k)) for n, k in kinds.items()], _file(F.col(_PART)).alias(_PART))


def _common(layouts: Sequence[T.StructType]) -> dict[str, T.DataType]:
    """Columns in the order of their first appearance, each with the type that takes all of its."""
    kinds: dict[str, T.DataType] = {}
    for f in (f for layout in layouts for f in layout):
        kinds[f.name] = wider_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return kinds


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """All parquet parts under a folder as one table.

    The parts must have the same set of columns. Their order may differ, and their
    types, which are widened. See ``read_united`` for the scans.
    """
    footers = materialize(part_footers(find_parts(spark, folder)), "footers")
    layouts = distinct_layouts(footers)
    if not layouts:
        raise FileNotFoundError(f"no parquet files under {folder}")
    require_same_leaves({f"layout {i}": layout for i, layout in enumerate(layouts)})
    return read_united(spark, folder, footers, _common(layouts)).drop(_PART)


def read_profiles(spark: SparkSession, paths: str | Sequence[str], plate_column: str = PLATE) -> DataFrame:
    """Profile files as one table; columns that a file lacks are null there.

    ``paths`` is a folder, a pattern or several of these or of files. Files without a
    plate column get the plate from their name.
    """
    if not paths:
        raise FileNotFoundError("no profiles to load")
    footers = materialize(part_footers(_listing(spark, paths)), "footers")
    layouts = distinct_layouts(footers)
    if not layouts:
        raise FileNotFoundError("no profiles to load")
    kinds = _common(layouts)
    plates = [plate_column in layout.fieldNames() for layout in layouts]
    if not any(plates):
        kinds |= {plate_column: T.StringType()}
    united = read_united(spark, paths, footers, kinds)
    if all(plates):
        return united.drop(_PART)
    text = united.withColumn(plate_column, column(plate_column).cast("string"))
    has = F.array_contains(F.json_object_keys("fields"), plate_column)
    lacking, found = settled(footers.filter(~has).select(_file(F.col("path")).alias(_PART), F.lit(True).alias("__named")), "unnamed")
    joined = text.join(small_side(lacking, found), _PART, "left")
    named = F.when(F.col("__named"), plate_from_file_name(F.element_at(F.split(_PART, "/"), -1)))
    return joined.withColumn(plate_column, F.coalesce(named, column(plate_column))).drop(_PART, "__named")
