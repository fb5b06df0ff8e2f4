"""Writers of tables: folders of part files, or files that are named after their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.columns import PLATE, SITE, WELL, column, columns
from platewise.operators.images import chunk_manifest, chunked_sets
from platewise.operators.index import NUCLEI_X, NUCLEI_Y
from platewise.operators.joins import join_null_safe
from platewise.session import materialize, settled, small_side
from platewise.sinks.named import csv_header, csv_line, write_named_files


class RowCountMismatch(ValueError):
    """Rows were lost or gained while writing."""


class ContentMismatch(ValueError):
    """As many rows were written as there are, but not the same ones."""


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def write_csv_file(df: DataFrame, path: str, name: str | Column, order: Sequence[Column] = ()) -> str:
    """A table of a plate's size as CSV of the given name; a column of names makes one file each."""
    file = F.lit(name) if isinstance(name, str) else name
    return write_named_files(df, path, file, csv_line(df.columns), order, header=csv_header(df.columns))


def _text(name: str) -> Column:
    return column(name).cast("string")


def write_locations(
    locations: DataFrame,
    path: str,
    max_file_rows: int | None = None,
    order: Sequence[str] = (NUCLEI_X, NUCLEI_Y),
    *,
    own_folders: bool = False,
) -> str:
    """Nuclei centres with a bare header, in files ``<plate>/<well>-<site>-Nuclei.csv``.

    With ``own_folders`` each plate has a folder for all that is its own, and its files
    are ``<plate>/locations/<plate>/<well>-<site>-Nuclei.csv``.

    A site's nuclei come in ``order``, so the same table gives the same bytes. A site is
    one task's, which streams it; with ``max_file_rows`` one of more nuclei is spread over
    several tasks and files, the further ones called ``<well>-<site>-Nuclei.<n>.csv``.
    """
    keys = [PLATE, WELL, SITE]
    nuclei = locations.select(*columns(dict.fromkeys([*keys, NUCLEI_X, NUCLEI_Y, *order])))
    share: Column = F.lit("")
    if max_file_rows is not None:
        sizes = nuclei.groupBy(*columns(keys)).agg(F.count("*").alias("__rows"))
        large = sizes.where(F.col("__rows") > max_file_rows).select(
            *columns(keys), F.ceil(F.col("__rows") / max_file_rows).alias("__files")
        )
        large, found = settled(large, "large-sites")
        nuclei = join_null_safe(nuclei, small_side(large, found), keys, "left")
        number = F.pmod(F.xxhash64(*columns([NUCLEI_X, NUCLEI_Y])), F.coalesce("__files", F.lit(1)))
        share = F.when(number > 0, F.concat(F.lit("."), number)).otherwise("")
    within = F.concat(_text(PLATE), F.lit("/locations/")) if own_folders else F.lit("")
    file = F.concat(within, _text(PLATE), F.lit("/"), _text(WELL), F.lit("-"), _text(SITE), F.lit("-Nuclei"), share, F.lit(".csv"))
    return write_named_files(
        nuclei,
        path,
        file,
        csv_line([NUCLEI_X, NUCLEI_Y]),
        columns(order),
        header=f"{NUCLEI_X},{NUCLEI_Y}",
    )


def write_chunks(sets: DataFrame, path: str, size: int, *, by_plate: bool = True) -> int:
    """Image sets and image manifests of each chunk; returns the number of chunks.

    Files ``chunk<i>.load_data.csv`` hold the sets in order of well and site under a
    header, ``chunk<i>.images.txt`` the sorted names of their images. They lie in a folder
    per plate, or in ``path`` itself for the chunks of one plate.
    """
    chunked = materialize(chunked_sets(sets, size), "chunks")
    # A chunk's rows are brought into one task once, for either table: the manifest's
    # distinct names need no shuffle of their own then.
    together = chunked.repartition(PLATE, "chunk")
    folder = F.concat(_text(PLATE), F.lit("/")) if by_plate else F.lit("")

    def file(ending: str) -> Column:
        return F.concat(folder, F.lit("chunk"), _text("chunk"), F.lit(ending))

    names = [c for c in chunked.columns if c != "chunk"]
    write_named_files(
        together,
        path,
        file(".load_data.csv"),
        csv_line(names),
        columns([WELL, SITE]),
        header=csv_header(names),
        deal=False,
    )
    listed = chunk_manifest(together, ordered=False)
    write_named_files(listed, path, file(".images.txt"), column("FileName"), [column("FileName")], deal=False)
    # Chunks of a plate are numbered from 1 without gaps.
    last = chunked.groupBy(PLATE).agg(F.max("chunk").alias("chunks"))
    return last.agg(F.coalesce(F.sum("chunks"), F.lit(0))).first()[0]


def row_digest(df: DataFrame) -> tuple[int, int, int]:
    """Number of rows and two sums of row hashes: equal for tables of the same rows in any order.

    A row's hashes read every column and tell a null from any value and the places of nulls
    apart; maps count by their sorted entries. Sums of two seeds in 128 bits do not wrap.
    """
    cells = []
    for f in df.schema:
        value = column(f.name)
        if isinstance(f.dataType, T.MapType):
            value = F.sort_array(F.map_entries(value))
        elif _has_map(f.dataType):
            value = F.to_json(F.struct(value))
        cells += [value, value.isNull()]
    sums = [
        F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0)) for seed in (1, 2)
    ]
    return tuple(int(v) for v in df.agg(F.count("*"), *sums).first())


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def require_same_rows(expected: tuple[int, int, int], found: tuple[int, int, int]) -> None:
    """Raise unless two digests are of the same rows."""
    if expected[0] != found[0]:
        raise RowCountMismatch(f"input has {expected[0]} rows, output has {found[0]}")
    if expected != found:
        raise ContentMismatch(f"{found[0]} rows were written, but not the same as in the input")


def write_lossless(df: DataFrame, path: str) -> int:
    """Write parquet and check that the output holds the rows of the input, value by value.

    Both sides are reduced to an order-free digest of their rows. The input's is one more
    pass over it: one taken while writing would count the rows of repeated tasks twice.
    """
    expected = row_digest(df)
    write_parquet(df, path)
    require_same_rows(expected, row_digest(df.sparkSession.read.schema(df.schema).parquet(path)))
    return expected[0]
