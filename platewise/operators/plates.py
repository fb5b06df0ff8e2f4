"""Per-well quality values and their plate grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.columns import (
    PLATE,
    WELL,
    array_of,
    column,
    columns,
    detect_well_column,
    quoted,
    split_metadata_features,
)
from platewise.functions.vectors import mean_absolute
from platewise.functions.wells import well_column, well_row
from platewise.operators.joins import join_null_safe
from platewise.operators.quantiles import MAX_GROUP_ROWS, percentile_by_key
from platewise.session import materialize

# Rows and columns of 96-, 384- and 1536-well plates.
STANDARD_PLATES = ((8, 12), (16, 24), (32, 48))
COLOUR_PERCENTILE = 0.99
# Share of a plate's positions that may lie beyond its shape before the shape grows.
OUTLYING = 0.02


def cells_per_well(cells: DataFrame, plate_col: str | None = None) -> DataFrame:
    """Number of single cells per well, and per plate when a plate column is named."""
    well = column(detect_well_column(cells.columns)).alias("well")
    plate = [column(plate_col).alias("plate")] if plate_col else []
    return cells.groupBy(*plate, well).agg(F.count("*").alias("value"))


def mean_absolute_features(
    profiles: DataFrame, keep: Sequence[str], features: Sequence[str] | None = None
) -> DataFrame:
    """Mean of the absolute feature values of each row, missing ones skipped."""
    if features is None:
        features = split_metadata_features(profiles)[1]
    values = array_of(f"CAST({quoted(name)} AS DOUBLE)" for name in features)
    return profiles.select(*columns(keep), mean_absolute(values).alias("value"))


def well_values(
    cells: DataFrame | None,
    profiles: DataFrame | None,
    plate_col: str = PLATE,
    features: Sequence[str] | None = None,
) -> tuple[DataFrame, str]:
    """Quality value per plate and well with its label.

    The cell count where single cells are given, else the mean size of the
    profile's features.
    """
    if cells is not None:
        return cells_per_well(cells, plate_col), "cell count"
    if profiles is None:
        raise ValueError("neither single cells nor profiles are given")
    values = mean_absolute_features(profiles, [plate_col, WELL], features)
    named = values.select(
        column(plate_col).alias("plate"), column(WELL).cast("string").alias("well"), "value"
    )
    return named, "mean |feature|"


def parse_wells(df: DataFrame, well: str = "well") -> DataFrame:
    """Add 0-based ``row`` and ``col``; both null for names that are no well."""
    return df.withColumns({"row": well_row(column(well)), "col": well_column(column(well))})


def on_grid(df: DataFrame, well: str = "well") -> DataFrame:
    """``parse_wells`` without the rows that have no place on a plate."""
    return parse_wells(df, well).where(_on_plate())


def _on_plate() -> Column:
    return F.col("row").isNotNull() & F.col("col").isNotNull()


def grid_shape(parsed: DataFrame) -> DataFrame:
    """One row: the smallest standard plate holding every well, else an exact fit.

    Takes the result of ``parse_wells`` or ``on_grid``. The former is cheaper
    behind an aggregation, as Spark would move a filter on the well before it.
    """
    rows, cols = F.max(F.when(_on_plate(), F.col("row"))), F.max(F.when(_on_plate(), F.col("col")))
    fits = F.struct((rows + 1).alias("n_rows"), (cols + 1).alias("n_cols"))
    for n_rows, n_cols in reversed(STANDARD_PLATES):
        plate = F.struct(
            F.lit(n_rows).cast("long").alias("n_rows"), F.lit(n_cols).cast("long").alias("n_cols")
        )
        fits = F.when((rows < n_rows) & (cols < n_cols), plate).otherwise(fits)
    return parsed.agg(fits.alias("shape")).select("shape.*")


def plate_grid(values: DataFrame) -> DataFrame:
    """Every grid position of every plate with its value, null where no well is.

    ``values`` holds plate, well and value. Two spellings of one position, such
    as ``A1`` and ``A01``, are settled by the later name.
    """
    # One row per well, read twice: for the shape and for the values. The filter comes
    # after writing, lest Spark move it before the aggregation that made the values.
    parsed = materialize(parse_wells(values.select("plate", "well", "value")), "well-values")
    placed = parsed.where(_on_plate())
    n_rows, n_cols = grid_shape(placed).first()
    if n_rows is None:
        raise ValueError("no parseable wells")

    def upto(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    positions = (
        placed.select("plate")
        .distinct()
        .withColumn("row", F.explode(upto(n_rows)))
        .withColumn("col", F.explode(upto(n_cols)))
    )
    settled = placed.groupBy("plate", "row", "col").agg(F.max_by("value", "well").alias("value"))
    return join_null_safe(positions, settled, ["plate", "row", "col"], "left")


def plate_shapes(parsed: DataFrame, outlying: float = OUTLYING) -> DataFrame:
    """The shape of every plate by itself: ``plate``, ``n_rows``, ``n_cols``, ``positions``, ``beyond``.

    The smallest standard plate that holds all but the share ``outlying`` of the plate's
    different positions, so a few stray labels do not size it; ``beyond`` counts those
    outside. Where more lie beyond the largest standard plate, the shape fits them all.
    A plate counts its positions per standard format, a handful of numbers whatever the
    number of wells. Plates without a readable well have null sizes.
    """
    placed = parsed.where(_on_plate()).groupBy("plate", "row", "col").agg(F.count("*").alias("__wells"))

    def outside(n_rows: int, n_cols: int) -> Column:
        return F.count_if((F.col("row") >= n_rows) | (F.col("col") >= n_cols))

    counts = placed.groupBy("plate").agg(
        F.count("*").alias("positions"),
        (F.max("row") + 1).alias("__rows"),
        (F.max("col") + 1).alias("__cols"),
        *[outside(*shape).alias(f"__outside_{i}") for i, shape in enumerate(STANDARD_PLATES)],
    )
    fits = F.struct(F.col("__rows").alias("n_rows"), F.col("__cols").alias("n_cols"), F.lit(0).cast("long").alias("beyond"))
    for i, (n_rows, n_cols) in reversed(list(enumerate(STANDARD_PLATES))):
        left_out = F.col(f"__outside_{i}")
        standard = F.struct(
            F.lit(n_rows).cast("long").alias("n_rows"), F.lit(n_cols).cast("long").alias("n_cols"), left_out.alias("beyond")
        )
        fits = F.when(left_out <= F.floor(F.lit(outlying) * F.col("positions")), standard).otherwise(fits)
    shaped = counts.withColumn("__shape", fits).select("plate", "__shape.*", "positions")
    every = parsed.select("plate").distinct()
    joined = join_null_safe(every, shaped, ["plate"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("positions", "beyond")})


def outlying_wells(parsed: DataFrame, shapes: DataFrame) -> DataFrame:
    """Labels that have no place on their plate, each once with its ``reason``: no well, or beyond the plate."""
    labels = parsed.groupBy("plate", "well").agg(F.first("row").alias("row"), F.first("col").alias("col"))
    sized = join_null_safe(labels, shapes.select("plate", "n_rows", "n_cols"), ["plate"], "left")
    away = (F.col("row") >= F.col("n_rows")) | (F.col("col") >= F.col("n_cols"))
    reason = F.when(~_on_plate(), "no well").when(away, "beyond the plate")
    return sized.withColumn("reason", reason).where("reason IS NOT NULL").select("plate", "well", "reason")


def plate_grids(values: DataFrame, outlying: float = OUTLYING) -> DataFrame:
    """``plate_grid`` with every plate in its own shape; what lies beyond it is left to ``outlying_wells``.

    Plates without a readable well have no grid.
    """
    parsed = materialize(parse_wells(values.select("plate", "well", "value")), "well-values")
    shapes = materialize(plate_shapes(parsed, outlying), "plate-shapes")

    def upto(size: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(size) - 1))

    sized = shapes.where("n_rows IS NOT NULL")
    positions = sized.withColumn("row", upto("n_rows")).withColumn("col", upto("n_cols")).select("plate", "row", "col")
    wells = parsed.where(_on_plate()).groupBy("plate", "row", "col").agg(F.max_by("value", "well").alias("value"))
    return join_null_safe(positions, wells, ["plate", "row", "col"], "left")


def colour_maximum(values: DataFrame, *, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """One row: 99th percentile over all wells of all plates, 1 where that is 0."""
    pooled = parse_wells(values).select(
        F.when(_on_plate(), F.col("value").cast("double")).alias("value")
    )
    top = percentile_by_key(
        materialize(pooled, "well-values"),
        [],
        "value",
        COLOUR_PERCENTILE,
        "value_max",
        max_group_rows=max_group_rows,
    )
    return top.select(
        F.when(F.col("value_max") == 0, 1.0).otherwise(F.col("value_max")).alias("value_max")
    )
