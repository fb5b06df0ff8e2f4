import math

import numpy as np
import pytest

from platewise.functions.text import plate_from_file_name, replace_extension
from platewise.operators import plates as P
from pyspark.sql import functions as F


def test_parse_wells(spark):
    names = ["A01", "b02", " H 12 ", "O19", "AA007", "A00", "A", "12", "", "A1x", None, "B1000000000000000000"]
    df = spark.createDataFrame([(n,) for n in names], "well string")
    got = {r.well: (r.row, r.col) for r in P.parse_wells(df).collect()}
    none = (None, None)
    assert got == {
        "A01": (0, 0), "b02": (1, 1), " H 12 ": (7, 11), "O19": (14, 18), "AA007": (26, 6),
        "A00": (0, -1), "A": none, "12": none, "": none, "A1x": none, None: none,
        "B1000000000000000000": (1, 999_999_999_999_999_999),
    }
    assert P.on_grid(df).count() == 7


@pytest.mark.parametrize("name", ["A" * 14 + "1", "C99999999999999999999"])
def test_wells_beyond_a_long_raise(spark, name):
    df = spark.createDataFrame([(name,)], "well string")
    with pytest.raises(Exception, match="beyond the range of a long"):
        P.parse_wells(df).collect()


@pytest.mark.parametrize(
    "row, col, shape", [(7, 11, (8, 12)), (8, 0, (16, 24)), (15, 23, (16, 24)), (31, 47, (32, 48)), (33, 60, (34, 61))]
)
def test_grid_shape(spark, row, col, shape):
    df = spark.createDataFrame([(0, 0), (row, col)], "row long, col long")
    assert tuple(P.grid_shape(df).first()) == shape


def test_cells_per_well(spark):
    df = spark.createDataFrame([("A01", 1), ("A01", 2), ("B02", 3)], "Image_Metadata_Well string, x int")
    assert {r.well: r.value for r in P.cells_per_well(df).collect()} == {"A01": 2, "B02": 1}
    with pytest.raises(KeyError, match="well column"):
        P.cells_per_well(df.select("x"))


def test_mean_absolute_features(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", -1.0, 3.0), ("b", nan, -2.0), ("c", None, nan), ("d", -inf, 1.0)]
    df = spark.createDataFrame(rows, "Metadata_Well string, x double, y double")
    got = {r.Metadata_Well: r.value for r in P.mean_absolute_features(df, ["Metadata_Well"]).collect()}
    assert got == {"a": 2.0, "b": 2.0, "c": None, "d": inf}


def test_well_values_prefers_cells(spark):
    cells = spark.createDataFrame([("p", "A01")], "Metadata_Plate string, Metadata_Well string")
    profiles = spark.createDataFrame([("p", "A01", -2.0)], "Metadata_Plate string, Metadata_Well string, f double")
    values, label = P.well_values(cells, profiles)
    assert (label, [tuple(r) for r in values.collect()]) == ("cell count", [("p", "A01", 1)])
    values, label = P.well_values(None, profiles)
    assert (label, [tuple(r) for r in values.collect()]) == ("mean |feature|", [("p", "A01", 2.0)])


def test_plate_grid_fills_empty_positions_and_takes_the_later_name(spark):
    rows = [("p", "A01", 1), ("p", "A1", 5), ("q", "H12", 2), ("q", "bad", 9)]
    grid = P.plate_grid(spark.createDataFrame(rows, "plate string, well string, value long"))
    assert grid.count() == 2 * 96
    filled = {(r.plate, r.row, r.col): r.value for r in grid.where("value is not null").collect()}
    assert filled == {("p", 0, 0): 5, ("q", 7, 11): 2}


@pytest.mark.parametrize("limit", [1000, 10])
def test_colour_maximum(spark, limit):
    values = np.random.default_rng(0).integers(0, 500, 96)
    wells = [f"{'ABCDEFGH'[i // 12]}{i % 12 + 1}" for i in range(96)]
    rows = [("p", w, int(v)) for w, v in zip(wells, values)] + [("p", "bad", 10_000)]
    df = spark.createDataFrame(rows, "plate string, well string, value long")
    got = P.colour_maximum(df, max_group_rows=limit).first().value_max
    assert math.isclose(got, np.percentile(values, 99))
    zeros = df.withColumn("value", F.lit(0))
    assert P.colour_maximum(zeros, max_group_rows=limit).first().value_max == 1.0


def test_name_functions(spark):
    df = spark.createDataFrame([("runA.clean.parquet",), ("runA.parquet",), ("a",)], "n string")
    got = df.select(plate_from_file_name(F.col("n")), replace_extension(F.col("n"), ".tiff")).collect()
    assert [tuple(r) for r in got] == [("runA", "runA.clean.tiff"), ("runA", "runA.tiff"), ("a", "a.tiff")]


def test_every_plate_has_its_own_shape_and_lists_what_lies_beyond(spark):
    wells = [("p96", f"{r}{c:02d}") for r in "ABCDEFGH" for c in range(1, 13)] + [("p96", "P24")]
    wells += [("p384", f"{r}{c:02d}") for r in "ABCDEFGHIJKLMNOP" for c in range(1, 25)] + [("p384", "bad"), ("p384", None)]
    wells += [("p384", "ZZ99"), ("p384", "AF48")]
    wells += [("p1536", f"AF{c:02d}") for c in range(1, 49)]
    wells += [("big", f"AM{c}") for c in range(1, 61)]
    wells += [("few", "A01"), ("few", "P24"), ("none", "x"), (None, "B02")]
    values = spark.createDataFrame([(p, w, i) for i, (p, w) in enumerate(wells)], "plate string, well string, value long")
    parsed = P.parse_wells(values)
    shapes = P.plate_shapes(parsed)
    found = {r.plate: (r.n_rows, r.n_cols, r.beyond, r.positions) for r in shapes.collect()}
    assert found == {
        "p96": (8, 12, 1, 97),
        "p384": (16, 24, 2, 386),
        "p1536": (32, 48, 0, 48),
        "big": (39, 60, 0, 60),
        "few": (16, 24, 0, 2),
        "none": (None, None, 0, 0),
        None: (8, 12, 0, 1),
    }
    out = {(r.plate, r.well): r.reason for r in P.outlying_wells(parsed, shapes).collect()}
    beyond, none = "beyond the plate", "no well"
    assert out == {
        ("p96", "P24"): beyond,
        ("p384", "ZZ99"): beyond,
        ("p384", "AF48"): beyond,
        ("p384", "bad"): none,
        ("p384", None): none,
        ("none", "x"): none,
    }
    grids = P.plate_grids(values)
    sizes = {r.plate: r["count"] for r in grids.groupBy("plate").count().collect()}
    assert sizes == {"p96": 96, "p384": 384, "p1536": 1536, "big": 2340, "few": 384, None: 96}
    assert grids.filter("value IS NOT NULL").count() == 96 + 384 + 48 + 60 + 2 + 1
