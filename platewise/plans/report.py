"""The tables behind the quality report of a cohort."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.columns import BATCH, COMPOUND, CONTROL_COMPOUND, PLATE, WELL
from platewise.operators.embedding import embed
from platewise.operators.features import FeatureTable, InsufficientData, feature_table
from platewise.operators.plates import colour_maximum, plate_grid, well_values
from platewise.operators.ranking import with_category_rank
from platewise.operators.replicates import Reproducibility, reproducibility
from platewise.operators.similarity import TOP_PROFILES, compound_similarity
from platewise.session import materialize

ROW_ID = "row_id"


@dataclass
class Report:
    """Results by name; ``skipped`` says why a result is absent."""

    plates: DataFrame | None = None
    plates_label: str | None = None
    plates_maximum: DataFrame | None = None
    embedding: DataFrame | None = None
    replicates: Reproducibility | None = None
    similarity: DataFrame | None = None
    skipped: dict[str, str] = field(default_factory=dict)


def cohort_table(cohort: DataFrame) -> FeatureTable:
    """Cleaned feature vectors of a cohort, one row per well, under ``row_id``."""
    named = [c for c in (PLATE, WELL, COMPOUND, BATCH) if c in cohort.columns]
    text = cohort.withColumns({c: F.col(c).cast("string") for c in named})
    ident = F.concat_ws("/", *[c for c in (PLATE, WELL) if c in named], F.monotonically_increasing_id())
    # Written out with the id, which must not change between readings.
    numbered = materialize(text.withColumn(ROW_ID, ident), "cohort")
    return feature_table(numbered, [ROW_ID, *named])


def build_report(
    *,
    cells: DataFrame | None = None,
    profiles: DataFrame | None = None,
    consensus: DataFrame | None = None,
    control: str = CONTROL_COMPOUND,
    top_n: int = TOP_PROFILES,
) -> Report:
    """Every result the given tables support.

    The cohort is cleaned once and shared by the embedding and the replicates. A result
    that cannot be made, by what the data lack or by a failed job, leaves the others.
    """
    report = Report()

    def attempt(name: str, build) -> None:
        try:
            build()
        except (InsufficientData, ValueError, KeyError, PySparkException) as reason:
            report.skipped[name] = str(reason)

    def plates() -> None:
        values, report.plates_label = well_values(cells, profiles)
        values = materialize(values, "well-values")
        report.plates = plate_grid(values)
        report.plates_maximum = colour_maximum(values)

    attempt("plates", plates)
    if profiles is not None:
        table = cohort_table(profiles)

        def embedding() -> None:
            found = embed(table)
            report.embedding = (
                with_category_rank(found, PLATE, "plate_rank") if PLATE in found.columns else found
            )

        def replicates() -> None:
            if COMPOUND not in table.rows.columns:
                raise InsufficientData(f"no {COMPOUND} column")
            report.replicates = reproducibility(table, ROW_ID, COMPOUND, control)

        attempt("embedding", embedding)
        attempt("replicates", replicates)

    def similar() -> None:
        if consensus is None or COMPOUND not in consensus.columns:
            raise InsufficientData(f"no consensus with a {COMPOUND} column")
        text = consensus.withColumn(COMPOUND, F.col(COMPOUND).cast("string"))
        report.similarity = compound_similarity(
            feature_table(text, [COMPOUND]), control=control, top_n=top_n
        )

    attempt("similarity", similar)
    return report
