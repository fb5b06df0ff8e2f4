"""From segmentation output to the index and nuclei locations of a plate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.columns import PLATE, SITE, WELL, require_columns
from platewise.operators.index import (
    MAP_ANNOTATIONS,
    MAP_PLATE,
    MAP_WELL,
    build_index,
    clean_locations,
    index_order,
    join_platemap,
    single_plate,
    unmatched_wells,
)
from platewise.session import materialize
from platewise.sinks.tables import write_csv_file, write_locations
from platewise.sources.tables import read_image_table, read_locations, read_platemap


@dataclass(frozen=True)
class PlateIndex:
    """What was written for a plate, and the index keys its plate map lacks."""

    plate: str
    sites: int
    nuclei: int
    unmatched: list[str] = field(default_factory=list)


def write_plate_index(
    spark: SparkSession,
    image_tables: str,
    locations: str | None,
    platemap: str,
    dest: str,
    *,
    plate: str | None = None,
    plate_col: str | None = MAP_PLATE,
    well_col: str = MAP_WELL,
    cols: Sequence[str] | None = MAP_ANNOTATIONS,
) -> PlateIndex:
    """Write ``metadata/index.csv`` and ``locations/<plate>`` of one plate under ``dest``.

    ``plate`` is used when the image table has no plate column; without it the plate is
    named by its folder: the one that holds the folder with the image tables.
    """
    table = read_image_table(spark, image_tables)
    above = image_tables.rstrip("/").split("/")[:-2]
    plate = single_plate(table, plate or (above[-1] if above else None))
    if not plate:
        raise ValueError("neither the image table nor a folder names the plate")
    index = materialize(build_index(table, plate), "index")
    annotations = read_platemap(spark, platemap)
    missing = unmatched_wells(index, annotations, plate_col, well_col)
    annotated = join_platemap(index, annotations, plate_col, well_col, cols)
    write_csv_file(annotated, f"{dest}/metadata", "index.csv", index_order())

    nuclei_rows = 0
    if locations is not None:
        found = read_locations(spark, locations).withColumn(PLATE, F.lit(plate))
        nuclei = materialize(clean_locations(found, keep=[PLATE, WELL, SITE]), "locations")
        write_locations(nuclei, f"{dest}/locations")
        nuclei_rows = nuclei.count()
    # Keys of one plate's wells: bounded by the plate format.
    return PlateIndex(plate, annotated.count(), nuclei_rows, [r.key for r in missing.collect()])


def write_plate_indexes(
    spark: SparkSession,
    image_tables: str,
    locations: DataFrame | None,
    platemap: str,
    dest: str,
    *,
    plate_col: str = MAP_PLATE,
    well_col: str = MAP_WELL,
    cols: Sequence[str] | None = MAP_ANNOTATIONS,
) -> DataFrame:
    """``write_plate_index`` for image tables of any number of plates, in one set of jobs.

    Each plate has the folder ``<dest>/<plate>`` with its ``metadata/index.csv`` and
    ``locations/<plate>``. ``locations`` has plate, well, site and the two centres. Returns
    one row a plate: ``plate``, ``sites``, ``nuclei`` and ``unmatched``, the sorted keys that
    the plate map lacks. Image tables without a plate in every row raise.
    """
    table = read_image_table(spark, image_tables)
    require_columns(table, [PLATE])
    if table.where(F.trim(PLATE).isNull()).limit(1).count():
        raise ValueError("rows of the image tables name no plate")
    index = materialize(build_index(table), "index")
    annotations = read_platemap(spark, platemap)
    annotated = materialize(join_platemap(index, annotations, plate_col, well_col, cols), "annotated")
    write_csv_file(annotated, dest, F.concat(F.col(PLATE), F.lit("/metadata/index.csv")), index_order())
    sites = annotated.groupBy(F.col(PLATE).alias("plate")).agg(F.count("*").alias("sites"))
    if locations is None:
        found = sites.withColumn("nuclei", F.lit(0).cast("long"))
    else:
        nuclei = materialize(clean_locations(locations, keep=[PLATE, WELL, SITE]), "locations")
        write_locations(nuclei, dest, own_folders=True)
        counted = nuclei.groupBy(F.col(PLATE).cast("string").alias("plate")).agg(F.count("*").alias("nuclei"))
        found = sites.join(counted, "plate", "left").withColumn("nuclei", F.coalesce("nuclei", F.lit(0)))
    # A key is the plate and a well of the plate's format, so a plate's list is bounded.
    missing = unmatched_wells(index, annotations, plate_col, well_col)
    keys = missing.groupBy(F.regexp_extract("key", "^(.*)/[^/]*$", 1).alias("plate")).agg(
        F.sort_array(F.collect_list("key")).alias("unmatched")
    )
    joined = found.join(keys, "plate", "left")
    return joined.withColumn("unmatched", F.coalesce("unmatched", F.array().cast("array<string>")))
