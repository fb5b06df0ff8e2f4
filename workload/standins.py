"""The given tables in the roles of imaging tables.

``lineitem`` rows are single cells and image files, ``embeddings`` are well
profiles, ``orders`` are imaged sites and ``customer`` is a plate map.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.operators.index import SOURCE_X, SOURCE_Y

WIDTH = 64
PROFILE_FEATURES = [f"f_{i + 1}" for i in range(WIDTH)]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def well_name(row: Column, col: Column) -> Column:
    """Well of a 0-based row and column."""
    return F.concat(F.chr(row + 65), F.lpad((col + 1).cast("string"), 2, "0"))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Single cells: three features, grouped by plate and well."""
    c = F.col
    return table(spark, sf, "lineitem").select(
        c("l_returnflag").alias("Metadata_Plate"),
        well_name(c("l_suppkey") % 8, c("l_partkey") % 12).alias("Metadata_Well"),
        c("l_orderkey").alias("Metadata_Cell"),
        c("l_quantity").alias("Cells_Quantity"),
        c("l_extendedprice").alias("Nuclei_Price"),
        c("l_discount").alias("Cytoplasm_Discount"),
    )


def well_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Well names in good and bad spellings."""
    c = F.col
    li = table(spark, sf, "lineitem")
    well = well_name(c("l_suppkey") % 8, c("l_partkey") % 12)
    spelled = (
        F.when(c("l_linenumber") == 1, F.lower(well))
        .when(c("l_linenumber") == 2, F.concat(F.lit(" "), well, F.lit(" ")))
        .when(c("l_linenumber") == 3, F.concat(F.chr(c("l_partkey") % 26 + 65), well))
        .when(c("l_linenumber") == 4, F.concat(well, F.lit("x")))
        .when(c("l_linenumber") == 5, F.lit(""))
        .otherwise(well)
    )
    return li.select(spelled.alias("well")).distinct()


def image_files(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of image files with thumbnails, foreign names and unknown channels among them."""
    c = F.col
    name = F.concat(
        F.when(c("l_quantity") == 1, F.lit("notes")).otherwise(F.lit("2025-W51_")),
        well_name(c("l_suppkey") % 8, c("l_partkey") % 12),
        F.lit("_s"),
        c("l_orderkey") % 40 + 1,
        F.lit("_w"),
        c("l_linenumber"),
        F.when(c("l_discount") == 0, F.lit("_Thumb")).otherwise(F.lit("")),
        F.lit("_"),
        c("l_orderkey"),
        F.lit(".tif"),
    )
    folder = F.concat(F.lit("TimePoint_"), F.round(c("l_tax") * 100).cast("int"))
    return table(spark, sf, "lineitem").select(
        c("l_returnflag").alias("Metadata_Plate"), F.concat_ws("/", folder, name).alias("path")
    )


def image_table(spark: SparkSession, sf: str) -> DataFrame:
    """Image table of many plates as the segmentation software writes it."""
    c = F.col
    key = c("o_custkey")
    well = well_name(F.floor(key % 96 / 24), F.floor(key % 24 / 2))
    site = F.when(c("o_orderkey") % 9 == 0, F.lit("edge")).otherwise((c("o_orderkey") % 50).cast("string"))
    names = [
        F.concat(F.lit(" "), well, F.lit(f".w{n}."), c("o_orderkey"), F.lit(".tif ")).alias(
            f"FileName_Orig{channel}"
        )
        for n, channel in enumerate(["DNA", "Mito", "AGP", "RNA", "ER"], 1)
    ]
    return table(spark, sf, "orders").select(
        F.concat(F.lit("P"), F.floor(key / 96)).alias("Metadata_Plate"),
        F.concat(well, F.lit(" ")).alias("Metadata_Well"),
        site.alias("Metadata_Site"),
        *names,
    )


def plate_map(spark: SparkSession, sf: str) -> DataFrame:
    """Plate map that has two rows for most wells and none for some."""
    return whole_plate_map(spark, sf, F.col("c_acctbal") > 0)


def whole_plate_map(spark: SparkSession, sf: str, kept: Column | None = None) -> DataFrame:
    """Plate map of all customers, or of those for which ``kept`` holds."""
    c = F.col
    key = c("c_custkey")
    return (
        table(spark, sf, "customer")
        .where(F.lit(True) if kept is None else kept)
        .select(
            F.concat(F.lit("P"), F.floor(key / 96)).alias("Metadata_PlateID"),
            well_name(F.floor(key % 96 / 24), F.floor(key % 24 / 2)).alias(
                "Metadata_DestinationWell"
            ),
            c("c_mktsegment").alias("Metadata_Compound"),
            c("c_nationkey").cast("string").alias("Metadata_Batch"),
        )
    )


def locations(spark: SparkSession, sf: str) -> DataFrame:
    """Nuclei centres, many of them halfway between two integers."""
    c = F.col
    return table(spark, sf, "lineitem").select(
        c("l_returnflag").alias("Metadata_Plate"),
        well_name(c("l_suppkey") % 8, c("l_partkey") % 12).alias("Metadata_Well"),
        (c("l_orderkey") % 4 + 1).cast("string").alias("Metadata_Site"),
        (c("l_quantity") / 2).alias("Location_Center_X"),
        c("l_extendedprice").alias("Location_Center_Y"),
    )


def compartments(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Image table and three compartments; one source has no nuclei at all."""
    c = F.col
    source = F.concat(F.lit("src"), c("l_suppkey") % 5).alias("source")
    image = table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), c("s_suppkey") % 5).alias("source"),
        c("s_suppkey").alias("ImageNumber"),
        F.concat(F.lit("P"), c("s_nationkey")).alias("Image_Metadata_Plate"),
        well_name(c("s_suppkey") % 8, c("s_suppkey") % 12).alias("Image_Metadata_Well"),
    )
    li = table(spark, sf, "lineitem")
    cytoplasm = li.select(
        source,
        c("l_suppkey").alias("ImageNumber"),
        (c("l_orderkey") * 8 + c("l_linenumber")).alias("ObjectNumber"),
        c("l_partkey").alias("Parent_Cells"),
        c("l_orderkey").alias("Parent_Nuclei"),
        c("l_discount").alias("Texture"),
    )

    def objects(rows: DataFrame, number: str, value: str, name: str) -> DataFrame:
        key = [source, c("l_suppkey").alias("ImageNumber"), c(number).alias("ObjectNumber")]
        return rows.groupBy(*key).agg(F.max(value).alias(name))

    nuclei = li.where((c("l_linestatus") == "F") & (c("l_suppkey") % 5 != 3))
    return image, {
        "Cytoplasm": cytoplasm,
        "Cells": objects(li, "l_partkey", "l_quantity", "Area"),
        "Nuclei": objects(nuclei, "l_orderkey", "l_extendedprice", "Intensity"),
    }


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Well profiles of a cohort, one compound per label, label 0 the control."""
    c = F.col
    compound = F.when(c("label") == 0, F.lit("DMSO")).otherwise(
        F.concat(F.lit("HY-"), F.lpad(c("label").cast("string"), 3, "0"))
    )
    values = [c("embedding")[i].cast("double").alias(n) for i, n in enumerate(PROFILE_FEATURES)]
    return table(spark, sf, "embeddings").select(
        "vec_id", compound.alias("Metadata_Compound"), *values
    )


def dirty_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles with gaps, infinities, a constant feature and an empty one."""
    c = F.col
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return profiles(spark, sf).withColumns(
        {
            "f_1": F.when(c("vec_id") % 7 == 0, nan).otherwise(c("f_1")),
            "f_2": F.when(c("vec_id") % 5 == 0, inf)
            .when(c("vec_id") % 5 == 1, -inf)
            .otherwise(c("f_2")),
            "f_3": F.lit(5.0),
            "f_4": nan,
            "f_5": F.when(c("vec_id") % 3 == 0, c("f_5")),
        }
    )


def put_files(files: DataFrame, folder: str) -> int:
    """Write rows of ``file`` and ``content`` (bytes) as files under a shared folder, on the executors."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        target, base = (
            fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        )
        for batch in batches:
            for name, content in zip(batch["file"], batch["content"]):
                place = f"{base}/{name}"
                target.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with target.open_output_stream(place) as opened:
                    opened.write(content)
            yield batch[["file"]]

    return files.select("file", "content").mapInPandas(put, "file string").count()


def location_files(spark: SparkSession, sf: str) -> DataFrame:
    """A location file a plate, well and site; every other one has its columns swapped."""
    file = F.concat_ws("-", "Metadata_Well", "Metadata_Site", F.lit("Nuclei.csv"))
    x, y = (F.col(c).cast("string") for c in (SOURCE_X, SOURCE_Y))
    swapped = F.crc32(F.col("file")) % 2 == 0
    lines = locations(spark, sf).withColumn("file", F.concat_ws("/", "Metadata_Plate", file))
    line = F.when(swapped, F.concat_ws(",", y, x)).otherwise(F.concat_ws(",", x, y))
    header = F.when(swapped, f"{SOURCE_Y},{SOURCE_X}").otherwise(f"{SOURCE_X},{SOURCE_Y}")
    body = lines.groupBy("file").agg(F.array_join(F.collect_list(line), "\n").alias("body"))
    return body.select("file", F.concat(header, F.lit("\n"), "body", F.lit("\n")).cast("binary").alias("content"))


# Orders whose lines are in one SQLite file, and vectors in one archive.
FILE_ORDERS, FILE_VECTORS = 400, 100


def sqlite_files(spark: SparkSession, sf: str) -> DataFrame:
    """Databases of order lines; every other one lacks a column and declares another type."""

    def build(lines: pd.DataFrame) -> pd.DataFrame:
        import sqlite3

        number = int(lines["number"].iloc[0])
        con = sqlite3.connect(":memory:")
        if number % 2:
            con.execute("CREATE TABLE lines (l_orderkey INTEGER, l_linenumber NUMERIC, flag TEXT, price REAL)")
            names = ["l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"]
        else:
            con.execute("CREATE TABLE lines (price DECIMAL(12, 2), l_linenumber INTEGER, l_orderkey INTEGER)")
            names = ["l_extendedprice", "l_linenumber", "l_orderkey"]
        marks = ", ".join("?" * len(names))
        con.executemany(f"INSERT INTO lines VALUES ({marks})", lines[names].astype(object).values.tolist())
        con.commit()
        return pd.DataFrame({"file": [f"{number}.sqlite"], "content": [con.serialize()]})

    number = F.floor(F.col("l_orderkey") / FILE_ORDERS).alias("number")
    lines = table(spark, sf, "lineitem").select(
        number, "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return lines.groupBy("number").applyInPandas(build, "file string, content binary")


def embedding_files(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of embeddings with a dictionary of metadata, or with a table of it."""

    def build(vectors: pd.DataFrame) -> pd.DataFrame:
        import io

        import numpy as np

        vectors = vectors.sort_values("vec_id")
        number = int(vectors["number"].iloc[0])
        about = {"note": "x"} if number % 2 else np.array([["note", "x"]])
        out = io.BytesIO()
        np.savez(out, features=np.stack(list(vectors["embedding"])), metadata=about)
        return pd.DataFrame({"file": [f"P{number}/all.npz"], "content": [out.getvalue()]})

    number = F.floor(F.col("vec_id") / FILE_VECTORS).alias("number")
    vectors = table(spark, sf, "embeddings").select(number, "vec_id", "embedding")
    return vectors.groupBy("number").applyInPandas(build, "file string, content binary")


def profile_files(spark: SparkSession, sf: str) -> DataFrame:
    """A profile file per nation of suppliers; every other one names its plate by its file only."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        import io

        nation = int(rows["s_nationkey"].iloc[0])
        kept = rows[["s_suppkey", "s_nationkey", "s_acctbal"]]
        if nation % 2:
            kept = kept.assign(Metadata_Plate=f"inside{nation}", s_nationkey=kept["s_nationkey"].astype("int32"))
        out = io.BytesIO()
        kept.to_parquet(out, index=False)
        return pd.DataFrame({"file": [f"P{nation}.normalized.parquet"], "content": [out.getvalue()]})

    rows = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return rows.groupBy("s_nationkey").applyInPandas(build, "file string, content binary")


def supplier_images(spark: SparkSession, sf: str) -> DataFrame:
    """An image file per supplier, some of them thumbnails or no images at all."""
    c = F.col
    key = c("s_suppkey")
    name = F.concat(
        F.lit("run_"), well_name(key % 16, key % 24), F.lit("_s"), key % 9 + 1, F.lit("_w"), key % 7 + 1,
        F.when(key % 5 == 0, "_thumb").otherwise(""), F.lit("_"), key, F.when(key % 11 == 0, ".txt").otherwise(".tif"),
    )
    folder = F.concat(F.lit("TimePoint_"), c("s_nationkey"))
    return table(spark, sf, "supplier").select(
        F.concat_ws("/", folder, name).alias("file"), F.lit(b"").alias("content")
    )


def plate_wells(spark: SparkSession, sf: str) -> DataFrame:
    """Wells of plates of all formats: 96, 384 and 1,536 wells, a larger one, stray and bad labels."""
    c = F.col
    kind = c("l_orderkey") % 5
    rows = F.when(kind == 0, 8).when(kind == 1, 16).when(kind == 2, 32).otherwise(44)
    cols = F.when(kind == 0, 12).when(kind == 1, 24).when(kind == 2, 48).otherwise(60)
    row = c("l_partkey") % rows
    col = (c("l_suppkey") * 7 + c("l_linenumber") * 5 + c("l_orderkey")) % cols
    letters = F.when(row < 26, F.chr(row + 65)).otherwise(F.concat(F.lit("A"), F.chr(row + 39)))
    well = F.concat(letters, F.lpad((col + 1).cast("string"), 2, "0"))
    label = (
        F.when(kind == 4, F.concat(F.lit("?"), c("l_linenumber")))
        .when(c("l_partkey") % 211 == 0, F.lit("ZZ99"))
        .when(c("l_partkey") % 223 == 0, F.lit("empty"))
        .when(c("l_partkey") % 227 == 0, F.lit(None).cast("string"))
        .otherwise(well)
    )
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("F"), kind).alias("plate"), label.alias("well"), c("l_quantity").alias("value")
    )
