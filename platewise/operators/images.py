"""Raw image names to image sets: one row per imaged site with a file per channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.columns import PLATE, SITE, WELL, column
from platewise.functions.text import base_name, path_order
from platewise.operators.ranking import with_chunk_number

# Stain behind each channel number, and the microscope's file names
# <experiment>_<well>_s<site>_w<channel><anything>.
CHANNELS = {1: "DNA", 2: "Mito", 3: "AGP", 4: "RNA", 5: "ER"}
IMAGE_NAME_PATTERN = r"^[^_]+_[A-P][0-9]{2}_s[0-9]{1,2}_w[1-5]"
THUMBNAIL_MARK = "_thumb"
NAME_PREFIX = "Image_FileName_Orig"
SITE_KEY = [PLATE, WELL, SITE]

_ALL_CHANNELS = sum(1 << number for number in CHANNELS)


def channel_name(number: Column) -> Column:
    """Stain of a channel number, null for unknown channels."""
    table = F.create_map(*[F.lit(x) for pair in CHANNELS.items() for x in pair])
    return F.try_element_at(table, number)


def parse_images(files: DataFrame, path: str = "path", plate: str | None = None) -> DataFrame:
    """Image rows from file paths; thumbnails and other names are dropped.

    ``plate`` names every image; without it ``files`` must hold a plate column.
    """
    name = base_name(column(path))
    usable = ~F.lower(name).contains(THUMBNAIL_MARK) & name.rlike(IMAGE_NAME_PATTERN)
    # The pattern fixes what lies between the first underscores.
    parts = F.split(name, "_")
    return files.where(usable).select(
        (F.lit(plate) if plate is not None else column(PLATE)).alias(PLATE),
        column(path).alias("path"),
        name.alias("FileName"),
        parts[1].alias("Well"),
        F.substring(parts[2], 2, 2).try_cast("int").alias("Site"),
        F.substring(parts[3], 2, 1).try_cast("int").alias("ChannelNumber"),
    )


def require_images(images: DataFrame) -> DataFrame:
    """Raise when no image is left after parsing."""
    if images.isEmpty():
        raise FileNotFoundError("no channel image matches the naming convention")
    return images


def _site_columns() -> list[Column]:
    return [column(PLATE), F.col("Well").alias(WELL), F.col("Site").alias(SITE)]


def image_sets(
    images: DataFrame,
    *,
    images_subdir: str = "images",
    with_illum: bool = False,
    illum_subdir: str = "illum",
) -> DataFrame:
    """Pivot image rows to one row per plate, well and site.

    Of several files for one channel the last in path order is taken. A channel
    without a file is null; see ``incomplete_sets``.
    """
    # A site has a handful of files: a small list by hash, rather than text maxima by sorting.
    shot = F.struct("ChannelNumber", path_order(F.col("path")).alias("place"), "FileName")
    sites = images.groupBy(*_site_columns()).agg(F.collect_list(shot).alias("__shots"))

    def latest(number: int) -> Column:
        own = F.filter("__shots", lambda shot: shot["ChannelNumber"] == number)
        return F.array_max(own)["FileName"]

    files = {NAME_PREFIX + name: latest(number) for number, name in CHANNELS.items()}
    sets = sites.withColumns(files)
    listed = [column(c) for c in SITE_KEY]
    for name in CHANNELS.values():
        listed += [column(NAME_PREFIX + name), F.lit(images_subdir).alias(f"Image_PathName_Orig{name}")]
    if with_illum:
        for name in CHANNELS.values():
            listed += [
                F.lit(f"Illum{name}.npy").alias(f"Image_FileName_Illum{name}"),
                F.lit(illum_subdir).alias(f"Image_PathName_Illum{name}"),
            ]
    return sets.select(*listed)


def incomplete_sets(images: DataFrame) -> DataFrame:
    """Image sets that lack a channel, with the missing ones as ``w1, w4``."""
    seen = F.bit_or(F.expr("shiftleft(1, ChannelNumber)"))
    lacking = images.groupBy(*_site_columns()).agg(seen.alias("__seen"))
    flags = [
        F.when(F.col("__seen").bitwiseAND(F.lit(1 << n)) == 0, F.lit(f"w{n}")) for n in CHANNELS
    ]
    return lacking.where(F.col("__seen") != _ALL_CHANNELS).select(
        *SITE_KEY, F.concat_ws(", ", *flags).alias("missing")
    )


def require_complete_sets(images: DataFrame) -> DataFrame:
    """Raise on the first incomplete image set in plate, well and site order."""
    first = incomplete_sets(images).orderBy(*SITE_KEY).first()
    if first is not None:
        plate, well, site, missing = first
        raise ValueError(f"incomplete site {site} of well {well}, plate {plate}: no file for {missing}")
    return images


def set_order() -> list[Column]:
    """The order of image sets: plate, well and site."""
    return [column(c).asc_nulls_last() for c in SITE_KEY]


def chunked_sets(sets: DataFrame, size: int) -> DataFrame:
    """Number the image sets of each plate in chunks of ``size``, by well and site."""
    return with_chunk_number(sets, size, [PLATE], [WELL, SITE])


def chunk_manifest(chunked: DataFrame, ordered: bool = True) -> DataFrame:
    """The distinct raw image names each chunk needs, sorted within the chunk."""
    names = [column(c) for c in chunked.columns if c.startswith(NAME_PREFIX)]
    manifest = (
        chunked.select(PLATE, "chunk", F.explode(F.array(*names)).alias("FileName"))
        .where(F.col("FileName").isNotNull())
        .distinct()
    )
    return manifest.orderBy(PLATE, "chunk", "FileName") if ordered else manifest
