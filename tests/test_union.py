import pytest
from pyspark.sql import types as T

from platewise.operators.union import leaf_names, loose_union, strict_union, wider_type
from platewise.plans.convert import concat_parts
from platewise.sources.parquet import parquet_columns, read_parts, read_profiles


def write(spark, path, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path))


def test_parts_are_found_in_folders_and_united_by_name(spark, tmp_path):
    parts = tmp_path / "parts"
    write(spark, parts / "a", "id int, label string", [(1, "x"), (2, "y")])
    write(spark, parts / "deep" / "b", "label string, id bigint", [("z", 2**40)])
    got = read_parts(spark, str(parts))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x"), (2, "y"), (2**40, "z")]
    assert dict(got.dtypes) == {"id": "bigint", "label": "string"}
    assert concat_parts(spark, str(parts), str(tmp_path / "out")) == 3
    assert parquet_columns(spark, str(tmp_path / "out")) == got.columns
    with pytest.raises(ValueError, match="destination"):
        concat_parts(spark, str(parts), str(parts / "out"))


def test_other_columns_and_no_parts_raise(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        read_parts(spark, str(tmp_path / "none"))
    write(spark, tmp_path / "parts" / "a", "id int, label string", [(1, "x")])
    write(spark, tmp_path / "parts" / "b", "id int, other int", [(2, 9)])
    with pytest.raises(ValueError, match=r"only some of 2 parts have.*'label'.*'other'"):
        read_parts(spark, str(tmp_path / "parts"))


def test_types_are_widened(spark):
    a = spark.createDataFrame([(1, 1.5, 3, True)], "a int, b double, c int, d boolean")
    b = spark.createDataFrame([("x", 2**40, 2.25, 7)], "a string, b bigint, c double, d int")
    got = strict_union({"a": a, "b": b})
    assert dict(got.dtypes) == {"a": "string", "b": "double", "c": "double", "d": "int"}
    assert [tuple(r) for r in got.collect()] == [("1", 1.5, 3.0, 1), ("x", float(2**40), 2.25, 7)]
    assert wider_type(T.LongType(), T.FloatType()) == T.FloatType()
    assert wider_type(T.DecimalType(10, 2), T.LongType()) == T.DecimalType(21, 2)
    assert wider_type(T.DecimalType(10, 2), T.DecimalType(6, 4)) == T.DecimalType(12, 4)
    assert wider_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert wider_type(T.NullType(), T.IntegerType()) == T.IntegerType()
    with pytest.raises(ValueError, match="common type"):
        wider_type(T.ArrayType(T.IntegerType()), T.StringType())


def test_leaf_names_look_into_structs():
    schema = T.StructType.fromDDL("a struct<b: int, c: int>, d date")
    assert leaf_names(schema) == {"b", "c", "d"}


def test_loose_union_fills_with_null(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert sorted(map(tuple, loose_union([a, b]).collect()), key=lambda r: r[0]) == [(1, 2, None), (4, None, 3)]
    with pytest.raises(FileNotFoundError):
        loose_union([])


def test_loose_union_widens_types(spark):
    a = spark.createDataFrame([(7, 1)], "plate bigint, x int")
    b = spark.createDataFrame([("P2", 2.5)], "plate string, x double")
    got = loose_union([a, b])
    assert dict(got.dtypes) == {"plate": "string", "x": "double"}
    assert sorted(map(tuple, got.collect())) == [("7", 1.0), ("P2", 2.5)]


def test_profiles_take_the_plate_from_the_file_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": [1]}), tmp_path / "runA.clean.parquet")
    pq.write_table(pa.table({"a": [2], "b": [5]}), tmp_path / "runB.parquet")
    paths = [str(tmp_path / n) for n in ("runA.clean.parquet", "runB.parquet")]
    got = {r.a: (r.Metadata_Plate, r.b) for r in read_profiles(spark, paths).collect()}
    assert got == {1: ("runA", None), 2: ("runB", 5)}
    with pytest.raises(FileNotFoundError):
        read_profiles(spark, [])


def _parts(spark, folder, frames):
    for name, (schema, rows) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / name))


def test_wider_numbers_are_one_scan_in_any_column_order(spark, tmp_path):
    frames = {
        "a": ("i int, x float, s string", [(1, 0.5, "p"), (None, None, None)]),
        "b": ("s string, x double, i long", [("q", 2.25, 1 << 40)]),
        "c": ("x float, s string, i short", [(1.5, "r", 7)]),
    }
    _parts(spark, tmp_path, frames)
    got = read_parts(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "double", "string"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        map(repr, [(1, 0.5, "p"), (None, None, None), (1 << 40, 2.25, "q"), (7, 1.5, "r")])
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan


def test_text_beside_numbers_times_and_nested_columns(spark, tmp_path):
    import datetime as dt

    day, moment = dt.date(2024, 2, 29), dt.datetime(2024, 3, 1, 12, 30)
    frames = {
        "a": ("k int, d date, v array<double>, m double", [(1, day, [1.0, None], 2.0)]),
        "b": ("v array<double>, k string, d timestamp, m double", [([], "x1", moment, -1.5), (None, None, None, None)]),
        "c": ("k long, m float, d date, v array<double>", [(1 << 40, 0.25, None, [3.0])]),
    }
    _parts(spark, tmp_path, frames)
    got = {r.k: (r.d, r.v, r.m) for r in read_parts(spark, str(tmp_path)).collect()}
    assert got == {
        "1": (dt.datetime(2024, 2, 29), [1.0, None], 2.0),
        "x1": (moment, [], -1.5),
        None: (None, None, None),
        str(1 << 40): (None, [3.0], 0.25),
    }


def test_profiles_of_a_folder_take_their_plate_from_the_file(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"a": [1, 2]}).to_parquet(tmp_path / "P1 odd+name.normalized.parquet")
    pd.DataFrame({"a": ["x", None], "Metadata_Plate": ["in", None]}).to_parquet(tmp_path / "P2.parquet")
    pd.DataFrame({"a": [3.5], "b": [True]}).to_parquet(tmp_path / "P3.parquet")
    rows = [(r.a, r.Metadata_Plate, r.b) for r in read_profiles(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, rows)) == sorted(
        map(repr, [("1", "P1 odd+name", None), ("2", "P1 odd+name", None), ("x", "in", None), (None, None, None), ("3.5", "P3", True)])
    )
