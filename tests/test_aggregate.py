import numpy as np
import pandas as pd
import pytest

from platewise.columns import detect_well_column, infer_features, split_metadata_features
from platewise.operators.aggregate import aggregate_median


def expected(frame: pd.DataFrame, strata, features) -> pd.DataFrame:
    grouped = frame.groupby(strata, dropna=False)[features].median().reset_index()
    return grouped.sort_values(strata, na_position="last").reset_index(drop=True)


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_even_and_odd_groups(spark):
    rng = np.random.default_rng(17)
    strata = ["Metadata_Batch", "Metadata_Dose"]
    sizes = [1, 2, 3, 8, 9]
    keys = pd.DataFrame({strata[0]: ["x", "x", "y", "y", "z"], strata[1]: [0, 5, 0, 5, 0]})
    frame = keys.loc[keys.index.repeat(sizes)].reset_index(drop=True)
    frame["Cytoplasm_Texture"] = rng.exponential(size=len(frame))
    frame["Cells_Count"] = rng.integers(-50, 50, len(frame)).astype(float)
    got = aggregate_median(spark.createDataFrame(frame.sample(frac=1, random_state=1)), strata).toPandas()
    same(got, expected(frame, strata, ["Cytoplasm_Texture", "Cells_Count"]))


@pytest.mark.parametrize("limit", [100_000, 1])
def test_nan_is_skipped_and_infinity_is_a_value(spark, limit):
    rows = [("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", float("inf")), ("b", 1.0), ("b", float("inf"))]
    df = spark.createDataFrame(rows + [("c", float("nan"))], "w string, x double")
    got = aggregate_median(df, ["w"], ["x"], max_group_rows=limit).collect()
    assert [tuple(r) for r in got] == [("a", 2.0), ("b", float("inf")), ("c", None)]


@pytest.mark.parametrize("limit", [100_000, 1])
def test_null_key_is_a_group_and_comes_last(spark, limit):
    rows = [(None, v) for v in (8.0, -2.0, 0.5, 4.5)] + [("late", 6.0), ("early", 1.0), ("early", 0.0)]
    got = aggregate_median(spark.createDataFrame(rows, "w string, x double"), ["w"], ["x"], max_group_rows=limit)
    assert [tuple(r) for r in got.collect()] == [("early", 0.5), ("late", 6.0), (None, 2.5)]


def test_features_come_in_the_asked_order_as_double(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True)], "w string, x int, `y.z` float, b boolean")
    got = aggregate_median(df, ["w"], ["y.z", "x", "b"])
    assert got.columns == ["w", "y.z", "x", "b"]
    assert {t for _, t in got.dtypes[1:]} == {"double"}
    assert tuple(got.first()) == ("a", 2.0, 1.0, 1.0)


@pytest.mark.parametrize("limit", [100_000, 40])
def test_many_features_in_blocks_match_pandas(spark, limit):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(300, 150)).astype("float32")
    values[rng.random(values.shape) < 0.1] = np.nan
    frame = pd.DataFrame(values, columns=[f"Cells_{i}" for i in range(150)])
    # One group holds two thirds of the rows.
    frame.insert(0, "w", np.where(np.arange(300) % 3 == 0, "b", "a"))
    frame.loc[:9, "w"] = "c"
    features = list(frame.columns[1:])
    got = aggregate_median(spark.createDataFrame(frame), ["w"], max_group_rows=limit).toPandas()
    want = expected(frame.astype({f: "float64" for f in features}), ["w"], features)
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-12)


def test_bad_arguments(spark):
    df = spark.createDataFrame([("a", 1.0)], "w string, x double")
    with pytest.raises(ValueError, match="strata"):
        aggregate_median(df, [], ["x"])
    with pytest.raises(ValueError, match="empty"):
        aggregate_median(df, ["w"], [])
    with pytest.raises(ValueError, match="infer|explicit"):
        aggregate_median(df, ["w"])
    with pytest.raises(ValueError, match="X"):
        aggregate_median(df, ["w"], ["X"])  # names are case-sensitive


def test_column_contract(spark):
    assert infer_features(["Metadata_Well", "Cells_A", "ImageNumber", "Nuclei_B", "Cytoplasm_C"]) == [
        "Cells_A",
        "Nuclei_B",
        "Cytoplasm_C",
    ]
    df = spark.createDataFrame(
        [], "Metadata_Plate string, Metadata_N int, e_1 double, n string, d decimal(5,2), b boolean"
    )
    assert split_metadata_features(df) == (["Metadata_Plate", "Metadata_N"], ["e_1", "b"])
    assert detect_well_column(["x", "Image_Metadata_Well"]) == "Image_Metadata_Well"
    with pytest.raises(KeyError, match="well column"):
        detect_well_column(["x"])
