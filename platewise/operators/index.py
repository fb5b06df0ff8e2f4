"""Site index of a plate: channel paths per site, annotated from a plate map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.columns import BATCH, COMPOUND, PLATE, SITE, WELL, column, columns, require_columns
from platewise.functions.text import joined_key, replace_extension

# Channel order of the index (not the channel-number order), the
# column names of nuclei locations, and the plate map's default columns.
INDEX_CHANNELS = ("DNA", "RNA", "ER", "AGP", "Mito")
SOURCE_X, SOURCE_Y = "Location_Center_X", "Location_Center_Y"
NUCLEI_X, NUCLEI_Y = "Nuclei_Location_Center_X", "Nuclei_Location_Center_Y"
MAP_PLATE, MAP_WELL = "Metadata_PlateID", "Metadata_DestinationWell"
MAP_ANNOTATIONS = (COMPOUND, BATCH)
CLASH_SUFFIX = "_platemap"


def build_index(image_table: DataFrame, plate: str | None = None) -> DataFrame:
    """One row per site with the stored image path of every channel.

    ``plate`` overrides the image table's own plate column. Order the result
    with ``order_index``.
    """
    wanted = {channel: f"FileName_Orig{channel}" for channel in INDEX_CHANNELS}
    require_columns(image_table, wanted.values(), KeyError)
    plate_id = F.lit(plate) if plate is not None else F.trim(column(PLATE).cast("string"))

    def stored(source: str) -> Column:
        name = F.trim(column(source).cast("string"))
        return F.concat(plate_id, F.lit("/"), replace_extension(name, ".tiff"))

    return image_table.select(
        plate_id.alias(PLATE),
        F.trim(column(WELL).cast("string")).alias(WELL),
        column(SITE),
        *[stored(source).alias(channel) for channel, source in wanted.items()],
    )


def site_order() -> list[Column]:
    """Well, then the site as a number, sites that are no number last."""
    number = F.expr(f"try_cast({SITE} AS double)")
    return [column(WELL).asc_nulls_last(), number.asc_nulls_last(), column(SITE).asc_nulls_last()]


def index_order() -> list[Column]:
    """Plate, well and site; images of one site by their paths, so the order is one."""
    return [column(PLATE).asc_nulls_last(), *site_order(), *[column(c).asc_nulls_last() for c in INDEX_CHANNELS]]


def order_index(index: DataFrame) -> DataFrame:
    return index.orderBy(*index_order())


def single_plate(image_table: DataFrame, fallback: str | None = None) -> str | None:
    """The one plate of an image table, ``fallback`` when it names none."""
    if PLATE not in image_table.columns:
        return fallback
    plates = F.trim(column(PLATE).cast("string"))
    first, last, unnamed = image_table.agg(
        F.min(plates), F.max(plates), F.count_if(plates.isNull())
    ).first()
    if first != last or (unnamed and first is not None):
        raise ValueError(f"image table spans multiple plates, from {first} to {last}")
    return first


def plates_of_tables(image_tables: DataFrame, table_col: str) -> DataFrame:
    """Of each image table its one plate, null where it names none or several.

    ``plates`` counts the names; ``unnamed`` says whether some rows have none beside them.
    """
    plate = F.trim(column(PLATE).cast("string"))
    found = image_tables.groupBy(column(table_col)).agg(
        F.min(plate).alias("__first"),
        F.count_distinct(plate).alias("plates"),
        (F.count_if(plate.isNull()) > 0).alias("unnamed"),
    )
    single = F.when((F.col("plates") == 1) & ~F.col("unnamed"), F.col("__first"))
    return found.select(column(table_col), single.alias("plate"), "plates", "unnamed")


def clean_locations(
    locations: DataFrame, as_int: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Nuclei centres under their index names, rounded half to even by default."""
    require_columns(locations, [SOURCE_X, SOURCE_Y, *keep], KeyError)

    def centre(name: str) -> Column:
        value = column(name).cast("double")
        return F.rint(value).cast("long") if as_int else value

    return locations.select(
        *columns(keep), centre(SOURCE_X).alias(NUCLEI_X), centre(SOURCE_Y).alias(NUCLEI_Y)
    )


def _map_keys(plate_col: str | None, well_col: str) -> dict[str, str]:
    """Index key column to plate-map key column; the plate is optional."""
    return {**({PLATE: plate_col} if plate_col else {}), WELL: well_col}


def join_platemap(
    index: DataFrame,
    platemap: DataFrame,
    plate_col: str | None = MAP_PLATE,
    well_col: str = MAP_WELL,
    cols: Sequence[str] | None = MAP_ANNOTATIONS,
) -> DataFrame:
    """Annotate the index with plate-map columns, keeping every index row.

    Repeated map rows repeat the index row. Without ``plate_col`` the wells
    alone are matched. Spark broadcasts the map when its size allows, otherwise
    both sides are shuffled and adaptive execution splits hot wells.
    """
    keys = _map_keys(plate_col, well_col)
    if cols is None:
        carried = list(platemap.columns)
    else:
        require_columns(platemap, [*keys.values(), *cols], KeyError)
        carried = list(dict.fromkeys([*keys.values(), *cols]))

    match = {key: f"__map_{i}" for i, key in enumerate(keys)}
    # A map key named like the index key is the same column, any other is redundant.
    names = [
        (c, c + CLASH_SUFFIX if c in index.columns else c)
        for c in carried
        if c not in keys.values()
    ]
    right = platemap.select(
        *[column(keys[key]).cast("string").alias(alias) for key, alias in match.items()],
        *[column(c).alias(alias) for c, alias in names],
    )
    left = index.withColumns({key: column(key).cast("string") for key in keys})
    condition = [column(key).eqNullSafe(F.col(alias)) for key, alias in match.items()]
    return left.join(right, condition, "left").drop(*match.values())


def unmatched_wells(
    index: DataFrame,
    platemap: DataFrame,
    plate_col: str | None = MAP_PLATE,
    well_col: str = MAP_WELL,
) -> DataFrame:
    """Sorted ``plate/well`` keys of the index that the plate map does not have.

    Both sides are reduced to distinct keys before they meet.
    """
    keys = _map_keys(plate_col, well_col)
    mine = index.select(*[column(k).cast("string").alias(k) for k in keys]).distinct()
    theirs = platemap.select(
        *[column(c).cast("string").alias(f"__map_{i}") for i, c in enumerate(keys.values())]
    ).distinct()
    condition = [column(k).eqNullSafe(F.col(f"__map_{i}")) for i, k in enumerate(keys)]
    missing = mine.join(theirs, condition, "left_anti")
    return missing.select(joined_key(columns(keys)).alias("key")).orderBy("key")
