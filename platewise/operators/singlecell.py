"""Segmented compartments joined into one row per cell."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.columns import PLATE, WELL, column, quoted
from platewise.session import materialize, small_side

COMPARTMENTS = ("Cells", "Nuclei", "Cytoplasm")
SOURCE = "source"
FLOAT32 = {"double": "float"}


@dataclass(frozen=True)
class CompartmentKeys:
    """Column names that tie the compartment tables together."""

    image: str = "ImageNumber"
    object: str = "ObjectNumber"
    cells_parent: str = "Cytoplasm_Parent_Cells"
    nuclei_parent: str = "Cytoplasm_Parent_Nuclei"
    image_plate: str = "Image_Metadata_Plate"
    image_well: str = "Image_Metadata_Well"


def cast_types(df: DataFrame, cast_map: Mapping[str, str] | None = FLOAT32) -> DataFrame:
    """Cast columns by type name; single-cell features are kept as float by default."""
    if not cast_map:
        return df
    kinds = {f.name: cast_map.get(f.dataType.typeName()) for f in df.schema}
    return df.selectExpr(
        *[
            f"CAST({quoted(name)} AS {kind}) AS {quoted(name)}" if kind else quoted(name)
            for name, kind in kinds.items()
        ]
    )


def source_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each compartment per source, 0 for a source that lacks it."""
    tagged = [
        tables[name].groupBy(SOURCE).agg(F.count("*").alias("rows")).withColumn("table", F.lit(name))
        for name in COMPARTMENTS
    ]
    counted = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return counted.groupBy(SOURCE).agg(
        *[F.sum(F.when(F.col("table") == n, F.col("rows")).otherwise(0)).alias(n) for n in COMPARTMENTS]
    )


def split_sources(tables: Mapping[str, DataFrame], sources: DataFrame | None = None) -> DataFrame:
    """Each source with ``complete``: whether every compartment has a row.

    ``sources`` lists sources that may have no rows at all.
    """
    counts = source_counts(tables)
    if sources is not None:
        counts = sources.select(SOURCE).distinct().join(counts, SOURCE, "left")
    filled = [F.coalesce(F.col(n), F.lit(0)) > 0 for n in COMPARTMENTS]
    return counts.select(SOURCE, (filled[0] & filled[1] & filled[2]).alias("complete"))


def join_compartments(
    image: DataFrame,
    tables: Mapping[str, DataFrame],
    keys: CompartmentKeys = CompartmentKeys(),
    *,
    skip_incomplete: bool = True,
) -> DataFrame:
    """One row per cytoplasm object with its image, cell and nucleus columns.

    Sources without rows in every compartment are left out. The cell and the
    nucleus are found by the parent numbers of the cytoplasm. Object columns
    are prefixed with their compartment, plate and well get canonical names.
    """
    cytoplasm, cells, nuclei = tables["Cytoplasm"], tables["Cells"], tables["Nuclei"]
    if skip_incomplete:
        good = materialize(split_sources(tables).where("complete").select(SOURCE), "sources")
        cytoplasm = cytoplasm.join(small_side(good, good.count()), SOURCE, "left_semi")

    def prefixed(df: DataFrame, name: str) -> DataFrame:
        start = name + "_"
        return df.withColumnsRenamed(
            {
                c: start + c
                for c in df.columns
                if c not in (SOURCE, keys.image) and not c.startswith(start)
            }
        )

    # Where the session lets a join reuse a partitioning by some of its keys, each table is
    # shuffled once, by image, and all three joins stay in place.
    reuse = "spark.sql.requireAllClusterKeysForCoPartition"
    together = cytoplasm.sparkSession.conf.get(reuse) == "false"

    def dealt(df: DataFrame) -> DataFrame:
        if not together:
            return df
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(tasks, column(SOURCE), column(keys.image))

    joined = dealt(prefixed(cytoplasm, "Cytoplasm"))
    for df, name, parent in (
        (cells, "Cells", keys.cells_parent),
        (nuclei, "Nuclei", keys.nuclei_parent),
    ):
        side = dealt(prefixed(df, name)).withColumnRenamed(f"{name}_{keys.object}", parent)
        joined = joined.join(side, [SOURCE, keys.image, parent], "left")

    canonical = {keys.image_plate: PLATE, keys.image_well: WELL}
    about = image.withColumnsRenamed({k: v for k, v in canonical.items() if k in image.columns})
    named = [c for c in about.columns if c not in (SOURCE, keys.image)]
    joined = joined.join(dealt(about), [SOURCE, keys.image], "left")
    rest = [c for c in joined.columns if c not in (SOURCE, keys.image, *named)]
    return joined.selectExpr(
        SOURCE,
        f"{quoted(keys.image)} AS {quoted(f'Metadata_{keys.image}')}",
        *map(quoted, [*named, *rest]),
    )
