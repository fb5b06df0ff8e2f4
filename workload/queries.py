"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.columns import COMPOUND, PLATE, SITE, WELL, split_metadata_features
from platewise.functions.wells import letters_to_row
from platewise.operators import images as I
from platewise.operators import index as X
from platewise.operators import plates as P
from platewise.operators import replicates as R
from platewise.operators import similarity as S
from platewise.operators.aggregate import aggregate_median, strata_order
from platewise.operators.embedding import embed
from platewise.operators.features import clean_features, feature_table, spread, standardise
from platewise.operators.neighbours import nearest_profiles, similar_profiles
from platewise.operators.ranking import with_category_rank
from platewise.operators.singlecell import cast_types, join_compartments, split_sources
from platewise.operators.union import loose_union, strict_union
from platewise.session import materialize, scratch_path
from platewise.sinks.ordered import read_in_order, write_in_order
from platewise.sinks.tables import (
    write_chunks,
    write_csv,
    write_locations,
    write_lossless,
)
from platewise.sources.parquet import parquet_columns, read_parts, read_profiles
from platewise.sources.embeddings import read_npz
from platewise.sources.listing import list_files
from platewise.sources.sqlite import read_sqlite_table
from platewise.sources.tables import read_image_table, read_locations, read_platemap
from workload import standins as D

Query = Callable[[SparkSession, str], DataFrame]
CHUNK = 100


def r6(value: Column) -> Column:
    """Six decimals, without negative zero."""
    return F.round(value, 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            r6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema
        ]
    )


# Aggregation


def a1_grouped_median(spark: SparkSession, sf: str) -> DataFrame:
    features = ["Cells_Quantity", "Nuclei_Price", "Cytoplasm_Discount"]
    return rounded(aggregate_median(D.cells(spark, sf), [PLATE, WELL], features))


def a1_median_nan_skip(spark: SparkSession, sf: str) -> DataFrame:
    price = F.when(F.col("Metadata_Cell") % 7 == 0, F.lit(float("nan"))).otherwise(
        F.col("Nuclei_Price")
    )
    cells = D.cells(spark, sf).withColumn("Nuclei_Price", price)
    return rounded(aggregate_median(cells, [WELL], ["Nuclei_Price"]))


def a1_median_null_group(spark: SparkSession, sf: str) -> DataFrame:
    cells = D.cells(spark, sf).withColumn(PLATE, F.nullif(F.col(PLATE), F.lit("N")))
    return rounded(aggregate_median(cells, [PLATE], ["Nuclei_Price", "Cells_Quantity"]))


def a1_median_hot_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The same medians by the path of groups that are too large for one buffer."""
    features = ["Nuclei_Price", "Cells_Quantity"]
    cells = D.cells(spark, sf)
    return rounded(aggregate_median(cells, [PLATE], features, max_group_rows=1000))


def a1_median_near_constant(spark: SparkSession, sf: str) -> DataFrame:
    """Hot groups of values that hardly differ, of very small ones and of infinite ones."""
    number = F.col("Metadata_Cell") % 5
    tiny = F.col("Metadata_Cell") % 4 * F.lit(1e-310)
    ends = F.when(number == 0, -F.lit(float("inf"))).when(number < 3, F.lit(float("inf"))).otherwise(F.col("Nuclei_Price"))
    cells = D.cells(spark, sf).withColumns(
        {"Cells_Near": F.lit(1000.0) + number * F.lit(1.2e-13), "Cells_Tiny": tiny, "Cells_Ends": ends}
    )
    medians = aggregate_median(cells, [PLATE], ["Cells_Near", "Cells_Tiny", "Cells_Ends"], max_group_rows=100)
    return medians.withColumn("Cells_Near", (F.col("Cells_Near") - 1000.0) * 1e13).withColumn(
        "Cells_Tiny", F.col("Cells_Tiny") * 1e300 * 1e10
    ).select(PLATE, *[F.round(c, 3).alias(c) for c in ("Cells_Near", "Cells_Tiny")], "Cells_Ends")


def p1_infer_features_median(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(aggregate_median(D.cells(spark, sf), [WELL]))


def a1_median_wide(spark: SparkSession, sf: str) -> DataFrame:
    """More features than one block holds."""
    profiles = D.profiles(spark, sf)
    doubled = profiles.withColumns({f"g_{i}": -F.col(f"f_{i}") for i in range(1, D.WIDTH + 1)})
    features = [c for c in doubled.columns if c[:2] in ("f_", "g_")]
    return rounded(aggregate_median(doubled, [COMPOUND], features))


# Plates


def _well_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.cells_per_well(D.cells(spark, sf), PLATE)


def a2_cells_per_well(spark: SparkSession, sf: str) -> DataFrame:
    return P.cells_per_well(D.cells(spark, sf))


def a7_mean_abs_feature(spark: SparkSession, sf: str) -> DataFrame:
    values = P.mean_absolute_features(D.profiles(spark, sf), ["vec_id"], D.PROFILE_FEATURES)
    return rounded(values)


def a8_pooled_p99(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.colour_maximum(_well_counts(spark, sf)))


def f1_parse_wells(spark: SparkSession, sf: str) -> DataFrame:
    return P.parse_wells(D.well_labels(spark, sf))


def f2_row_letters(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    first, second = F.chr(c("p_partkey") % 26 + 97), F.chr(c("p_size") % 26 + 65)
    letters = F.when(c("p_size") % 3 == 0, first).otherwise(F.concat(first, second))
    letters = F.when(c("p_size") % 5 == 0, F.concat(second, first, second)).otherwise(letters)
    return D.table(spark, sf, "part").select(
        "p_partkey", letters.alias("letters"), letters_to_row(letters).alias("row")
    )


def a9_grid_shape(spark: SparkSession, sf: str) -> DataFrame:
    return P.grid_shape(P.parse_wells(_well_counts(spark, sf)))


def j7_plate_grid(spark: SparkSession, sf: str) -> DataFrame:
    return P.plate_grid(_well_counts(spark, sf))


def _wells_by_plate(spark: SparkSession, sf: str) -> DataFrame:
    """One value a plate and label; the tables have several rows of each."""
    return D.plate_wells(spark, sf).groupBy("plate", "well").agg(F.count("*").alias("value"))


def a9_plate_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return P.plate_shapes(P.parse_wells(_wells_by_plate(spark, sf)))


def p18_outlying_wells(spark: SparkSession, sf: str) -> DataFrame:
    parsed = P.parse_wells(_wells_by_plate(spark, sf))
    return P.outlying_wells(parsed, P.plate_shapes(parsed))


def j7_plate_grids(spark: SparkSession, sf: str) -> DataFrame:
    """Every plate in its own shape."""
    return P.plate_grids(_wells_by_plate(spark, sf))


# Images


def _images(spark: SparkSession, sf: str) -> DataFrame:
    return I.parse_images(D.image_files(spark, sf))


def p7_parse_image_names(spark: SparkSession, sf: str) -> DataFrame:
    return _images(spark, sf).withColumn("Channel", I.channel_name(F.col("ChannelNumber")))


def a3_pivot_channels(spark: SparkSession, sf: str) -> DataFrame:
    return I.image_sets(_images(spark, sf), with_illum=True)


def a4_incomplete_sets(spark: SparkSession, sf: str) -> DataFrame:
    return I.incomplete_sets(_images(spark, sf))


def w1_chunk_number(spark: SparkSession, sf: str) -> DataFrame:
    chunked = I.chunked_sets(I.image_sets(_images(spark, sf)), CHUNK)
    return chunked.select(PLATE, WELL, SITE, "chunk")


def a15_chunk_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return I.chunk_manifest(I.chunked_sets(I.image_sets(_images(spark, sf)), CHUNK))


# Index


def p12_index_paths(spark: SparkSession, sf: str) -> DataFrame:
    return X.order_index(X.build_index(D.image_table(spark, sf)))


def p11_round_locations(spark: SparkSession, sf: str) -> DataFrame:
    return X.clean_locations(D.locations(spark, sf), keep=[PLATE, WELL, SITE])


def j1_platemap_left_join(spark: SparkSession, sf: str) -> DataFrame:
    index = X.build_index(D.image_table(spark, sf))
    return X.join_platemap(index, D.plate_map(spark, sf)).select(
        PLATE, WELL, SITE, "DNA", "Metadata_Compound", "Metadata_Batch"
    )


def j2_unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    return X.unmatched_wells(X.build_index(D.image_table(spark, sf)), D.plate_map(spark, sf))


# Stored order


def o1_strata_order(spark: SparkSession, sf: str) -> DataFrame:
    """Wells of medians as they lie in the written table, a null plate last."""
    path = scratch_path(spark, "medians")
    cells = D.cells(spark, sf).withColumn(PLATE, F.nullif(F.col(PLATE), F.lit("N")))
    medians = aggregate_median(cells, [PLATE, WELL], ["Nuclei_Price"], ordered=False)
    write_in_order(medians, path, strata_order([PLATE, WELL]))
    return rounded(read_in_order(spark, path))


def o2_index_order(spark: SparkSession, sf: str) -> DataFrame:
    """Sites of the index as they lie in the written table."""
    path = scratch_path(spark, "index")
    write_in_order(X.build_index(D.image_table(spark, sf)), path, X.index_order())
    return read_in_order(spark, path).select(PLATE, WELL, SITE, "DNA", "position")


def o3_site_order(spark: SparkSession, sf: str) -> DataFrame:
    """Image sets as they lie in the written table."""
    path = scratch_path(spark, "sets")
    write_in_order(I.image_sets(_images(spark, sf)), path, I.set_order())
    return read_in_order(spark, path).select(PLATE, WELL, SITE, "position")


# Single cells and unions


def j3_compartment_join(spark: SparkSession, sf: str) -> DataFrame:
    image, tables = D.compartments(spark, sf)
    return join_compartments(image, tables)


def a6_skip_empty_sources(spark: SparkSession, sf: str) -> DataFrame:
    return split_sources(D.compartments(spark, sf)[1])


def p5_cast_float(spark: SparkSession, sf: str) -> DataFrame:
    cast = cast_types(D.cells(spark, sf))
    features = split_metadata_features(cast)[1]
    return cast.groupBy(PLATE, WELL).agg(
        *[F.max(F.col(f).cast("double")).alias(f) for f in features]
    )


def _order_parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Orders in three parts with other column orders and types."""
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_custkey")
    part = {s: orders.where(F.col("o_orderstatus") == s) for s in ("O", "F", "P")}
    return {
        "open": part["O"].withColumn("o_custkey", key.cast("int")),
        "filled": part["F"].select("o_orderstatus", "o_totalprice", "o_orderkey", "o_custkey"),
        "pending": part["P"].withColumn("o_custkey", key.cast("string")),
    }


def u1_strict_union(spark: SparkSession, sf: str) -> DataFrame:
    return strict_union(_order_parts(spark, sf))


def u2_loose_union(spark: SparkSession, sf: str) -> DataFrame:
    parts = _order_parts(spark, sf)
    return loose_union(
        [parts["open"].drop("o_totalprice"), parts["filled"].drop("o_orderstatus"), parts["pending"]]
    )


# Features


def p14_clean_features(spark: SparkSession, sf: str) -> DataFrame:
    dirty = D.dirty_profiles(spark, sf)
    return rounded(clean_features(dirty, D.PROFILE_FEATURES, keep=["vec_id"]))


def a16_standardise(spark: SparkSession, sf: str) -> DataFrame:
    dirty = D.dirty_profiles(spark, sf)
    return rounded(spread(standardise(feature_table(dirty, ["vec_id"], D.PROFILE_FEATURES))))


def _cohort(spark: SparkSession, sf: str):
    return feature_table(D.profiles(spark, sf), ["vec_id", COMPOUND], D.PROFILE_FEATURES)


def _zscores(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(R.row_zscores(_cohort(spark, sf), ["vec_id", COMPOUND]), "zscores")


def a10_row_zscores(spark: SparkSession, sf: str) -> DataFrame:
    scaled = R.row_zscores(_cohort(spark, sf), ["vec_id"])
    return rounded(scaled.select("vec_id", F.posexplode(R.ZSCORES).alias("position", "z")))


def p19_flat_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Row z-scores where some profiles do not vary and have none."""
    flat = F.col("vec_id") % 10 == 3
    wells = D.profiles(spark, sf).withColumns({f: F.when(flat, 1.5).otherwise(F.col(f)) for f in D.PROFILE_FEATURES})
    scaled = R.row_zscores(feature_table(wells, ["vec_id"], D.PROFILE_FEATURES), ["vec_id"])
    return rounded(scaled.select("vec_id", F.posexplode(R.ZSCORES).alias("position", "z")))


def a11_replicate_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.replicate_scores(_zscores(spark, sf), "vec_id"))


def a11_replicate_score_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same scores by the path of compounds that do not fit one block."""
    return rounded(
        R.replicate_scores(
            _zscores(spark, sf), "vec_id", block_rows=24, large_block_rows=40, max_values=100
        )
    )


def j5_null_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.null_pairs(_zscores(spark, sf), "vec_id"))


def a12_null_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.null_threshold(R.null_pairs(_zscores(spark, sf), "vec_id")))


def a12_null_threshold_all(spark: SparkSession, sf: str) -> DataFrame:
    """The threshold over all pairs of wells of different compounds instead of drawn ones."""
    return rounded(R.null_threshold_all(_zscores(spark, sf), "vec_id"))


def a13_percent_replicating(spark: SparkSession, sf: str) -> DataFrame:
    found = R.reproducibility(_cohort(spark, sf), "vec_id")
    return rounded(R.percent_replicating(found.scores, found.threshold))


def a14_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.reproducibility(_cohort(spark, sf), "vec_id").histogram)


def o4_top_activity(spark: SparkSession, sf: str) -> DataFrame:
    top = S.most_active(S.activity(_cohort(spark, sf)), ["vec_id"])
    return rounded(top.select("vec_id", COMPOUND, S.ACTIVITY))


def a19_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(S.compound_similarity(_cohort(spark, sf), row_id="vec_id"))


def a19_nearest_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """The five profiles of all that are most like each, without the whole matrix."""
    return rounded(nearest_profiles(_cohort(spark, sf), "vec_id", 5))


def a19_similar_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(similar_profiles(_cohort(spark, sf), "vec_id", 0.4))


def w2_category_rank(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select("p_partkey", "p_name")
    return with_category_rank(part, "p_name")


def a20_pca2(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(embed(_cohort(spark, sf)))


# Files written from the tables and read back


def s2_image_table_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "image-csv")
    table = D.image_table(spark, sf)
    even = F.floor(F.length(PLATE) % 2) == 0
    write_csv(table.where(even), f"{path}/a")
    write_csv(table.where(~even).select(*reversed(table.columns)), f"{path}/b")
    return read_image_table(spark, [f"{path}/a", f"{path}/b"])


def s3_platemap_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "platemap")
    padded = D.whole_plate_map(spark, sf).select(
        F.concat(F.lit(" "), F.col("Metadata_PlateID"), F.lit(" ")).alias(" Metadata_PlateID "),
        "Metadata_DestinationWell",
        "Metadata_Compound",
        F.col("Metadata_Batch").alias(" Metadata_Batch"),
    )
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    padded.write.options(header="true", **kept).csv(path)
    return read_platemap(spark, path)


def _from_name(pattern: str) -> list[Column]:
    """Parts of a row's file path."""
    path = F.col("_metadata.file_path")
    return [F.regexp_extract(path, pattern, i + 1) for i in range(pattern.count("("))]


def k3_locations_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The files, found again by the name of their plate, well and site."""
    path = scratch_path(spark, "locations")
    nuclei = X.clean_locations(D.locations(spark, sf), keep=[PLATE, WELL, SITE])
    write_locations(nuclei, path)
    reader = spark.read.schema(f"{X.NUCLEI_X} bigint, {X.NUCLEI_Y} bigint").option("header", "true")
    plate, well, site = _from_name(r"/([^/]+)/([A-Z0-9]+)-([0-9]+)-Nuclei[.]csv$")
    found = reader.options(recursiveFileLookup="true", pathGlobFilter="*-*-Nuclei.csv").csv(path)
    return found.select(X.NUCLEI_X, X.NUCLEI_Y, plate.alias(PLATE), well.alias(WELL), site.alias(SITE))


def k4_chunk_files(spark: SparkSession, sf: str) -> DataFrame:
    """The lists of images, found again by the name of their chunk."""
    path = scratch_path(spark, "chunks")
    write_chunks(I.image_sets(_images(spark, sf)), path, CHUNK)
    plate, chunk = _from_name(r"/([^/]+)/chunk([0-9]+)[.]images[.]txt$")
    listed = spark.read.options(recursiveFileLookup="true", pathGlobFilter="chunk*.images.txt").text(path)
    return listed.select(plate.alias(PLATE), chunk.cast("bigint").alias("chunk"), F.col("value").alias("FileName"))


def k4_chunk_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The image sets that are written beside the file names."""
    path = scratch_path(spark, "chunks")
    sets = I.image_sets(_images(spark, sf))
    write_chunks(sets, path, CHUNK)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sets.schema)
    _, chunk = _from_name(r"/([^/]+)/chunk([0-9]+)[.]load_data[.]csv$")
    named = {"recursiveFileLookup": "true", "pathGlobFilter": "chunk*.load_data.csv"}
    found = spark.read.schema(kinds).options(header="true", **named).csv(path)
    return found.select(
        PLATE, WELL, SITE, chunk.cast("bigint").alias("chunk"),
        *[c for c in sets.columns if c.startswith(I.NAME_PREFIX)],
    )


def k5_lossless_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "cells")
    write_lossless(D.cells(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy(PLATE).agg(
        F.count("*").alias("rows"), *[F.count(c).alias(c) for c in parquet_columns(spark, path) if c != PLATE]
    )


def u1_parquet_parts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parts")
    for name, part in _order_parts(spark, sf).items():
        part.write.parquet(f"{path}/{name}")
    return read_parts(spark, path)


def s11_profile_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "profiles")
    for name, part in _order_parts(spark, sf).items():
        part.write.parquet(f"{path}/{name}")
    return read_profiles(spark, path, "o_orderstatus").groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"),
        r6(F.max("o_totalprice")).alias("top"),
        F.max("o_custkey").alias("last_key"),
    )


def f3_plate_from_name(spark: SparkSession, sf: str) -> DataFrame:
    """Profile files of which every other one lacks the plate, which its name has then."""
    path = scratch_path(spark, "named-profiles")
    D.put_files(D.profile_files(spark, sf), path)
    return read_profiles(spark, path).groupBy(PLATE).agg(
        F.count("*").alias("rows"), r6(F.max("s_acctbal")).alias("top"), F.sum("s_nationkey").alias("nations")
    )


def s1_image_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Image files of nested folders, listed and parsed; other files are among them."""
    path = scratch_path(spark, "plate")
    D.put_files(D.supplier_images(spark, sf), path)
    return I.parse_images(list_files(spark, path), plate="S").drop("path")


def a5_plates_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The plate of each image table; some tables hold two."""
    table = D.image_table(spark, sf)
    number = F.substring(PLATE, 2, 20).cast("long")
    held = F.concat(F.lit("T"), F.when(number % 3 == 0, number).otherwise(number - number % 3 + 1))
    return X.plates_of_tables(table.withColumn("table", held), "table")


def s4_locations_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "location-files")
    D.put_files(D.location_files(spark, sf), path)
    found = read_locations(spark, path).groupBy(WELL, SITE)
    totals = found.agg(
        F.count("*").alias("rows"), F.sum(X.SOURCE_X).alias("x"), F.sum(X.SOURCE_Y).alias("y")
    )
    return totals.select(WELL, SITE, "rows", *[F.round(c, 2).alias(c) for c in ("x", "y")])


def s9_sqlite_tables(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sqlite")
    D.put_files(D.sqlite_files(spark, sf), path)
    return read_sqlite_table(spark, path, "lines").drop("source")


def s10_npz_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "npz")
    D.put_files(D.embedding_files(spark, sf), path)
    cells = read_npz(spark, path, path_pattern=r"/P(?P<number>[0-9]+)/all[.]npz$")
    vec_id = F.expr(f"CAST(metadata['number'] AS BIGINT) * {D.FILE_VECTORS} + cell")
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return cells.select(
        vec_id.alias("vec_id"), F.element_at("metadata", "note").alias("note"), r6(total).alias("total")
    )


_ALL = [
    a1_grouped_median,
    a1_median_nan_skip,
    a1_median_null_group,
    a1_median_hot_groups,
    a1_median_near_constant,
    p1_infer_features_median,
    a1_median_wide,
    a2_cells_per_well,
    a7_mean_abs_feature,
    a8_pooled_p99,
    f1_parse_wells,
    f2_row_letters,
    a9_grid_shape,
    j7_plate_grid,
    a9_plate_shapes,
    p18_outlying_wells,
    j7_plate_grids,
    p7_parse_image_names,
    a3_pivot_channels,
    a4_incomplete_sets,
    w1_chunk_number,
    a15_chunk_manifest,
    p12_index_paths,
    p11_round_locations,
    j1_platemap_left_join,
    j2_unmatched_keys,
    o1_strata_order,
    o2_index_order,
    o3_site_order,
    j3_compartment_join,
    a6_skip_empty_sources,
    p5_cast_float,
    u1_strict_union,
    u2_loose_union,
    p14_clean_features,
    a16_standardise,
    a10_row_zscores,
    p19_flat_rows,
    a11_replicate_score,
    a11_replicate_score_blocks,
    j5_null_pairs,
    a12_null_threshold,
    a12_null_threshold_all,
    a13_percent_replicating,
    a14_histogram,
    o4_top_activity,
    a19_similarity,
    a19_nearest_profiles,
    a19_similar_profiles,
    w2_category_rank,
    a20_pca2,
    s2_image_table_csv,
    s3_platemap_csv,
    k3_locations_csv,
    k4_chunk_files,
    k4_chunk_tables,
    k5_lossless_parquet,
    u1_parquet_parts,
    s11_profile_files,
    f3_plate_from_name,
    s1_image_listing,
    a5_plates_of_tables,
    s4_locations_csv,
    s9_sqlite_tables,
    s10_npz_embeddings,
]


def all_queries() -> dict[str, Query]:
    return {query.__name__: query for query in _ALL}
