import numpy as np
import pandas as pd
import pytest

from platewise.operators.embedding import embed, leading_vectors
from platewise.operators.features import (
    InsufficientData,
    clean_features,
    feature_table,
    spread,
    standardise,
)


def cleaned(frame: pd.DataFrame) -> pd.DataFrame:
    matrix = frame.replace([np.inf, -np.inf], np.nan).dropna(axis=1, how="all")
    matrix = matrix.loc[:, matrix.nunique() > 1]
    return matrix.fillna(matrix.median())


@pytest.fixture
def dirty():
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.normal(size=(80, 6)), columns=[f"f{i}" for i in range(6)])
    frame.loc[::3, "f0"] = np.nan
    frame.loc[::4, "f1"] = np.inf
    frame.loc[1::4, "f1"] = -np.inf
    frame["const"] = 5.0
    frame["empty"] = np.nan
    frame["onegap"] = np.where(np.arange(80) == 3, np.nan, 2.0)
    return frame


@pytest.mark.parametrize("limit", [1000, 10])
def test_clean_features_like_pandas(spark, dirty, limit):
    df = spark.createDataFrame(dirty.assign(Metadata_id=range(80), note="x"))
    got = clean_features(df, max_group_rows=limit).orderBy("Metadata_id").toPandas()
    want = cleaned(dirty)
    assert list(got.columns) == ["Metadata_id", *want.columns]
    np.testing.assert_allclose(got[want.columns], want)


def test_text_features_are_coerced(spark):
    df = spark.createDataFrame([("1",), ("x",), ("3",), ("4",)], "f string")
    assert sorted(r.f for r in clean_features(df, ["f"]).collect()) == [1.0, 3.0, 3.0, 4.0]


def test_standardise(spark, dirty):
    df = spark.createDataFrame(dirty.assign(Metadata_id=range(80)))
    got = spread(standardise(feature_table(df, ["Metadata_id"]))).orderBy("Metadata_id").toPandas()
    want = cleaned(dirty)
    np.testing.assert_allclose(got[want.columns], (want - want.mean()) / want.std(ddof=0), atol=1e-12)


def test_embedding_is_the_principal_plane(spark, cohort):
    frame = cohort()
    df = spark.createDataFrame(frame.assign(Metadata_id=range(len(frame))))
    got = embed(feature_table(df, ["Metadata_id"])).orderBy("Metadata_id").toPandas()
    x = frame.filter(like="feature_").to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    for i, name in enumerate(["component_1", "component_2"]):
        want = u[:, i] * s[i]
        np.testing.assert_allclose(np.abs(got[name]), np.abs(want), atol=1e-8)


def test_embedding_guards(spark, cohort):
    frame = cohort().assign(Metadata_id=range(48))
    with pytest.raises(InsufficientData, match="wells"):
        embed(feature_table(spark.createDataFrame(frame.head(4)), ["Metadata_id"]))
    with pytest.raises(InsufficientData, match="features"):
        embed(feature_table(spark.createDataFrame(frame), ["Metadata_id"], ["feature_1"]))


@pytest.mark.parametrize("rows,width", [(200, 5000), (300, 64), (50, 2), (60, 3), (4000, 150)])
def test_leading_vectors_are_those_of_a_singular_value_decomposition(rows, width):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(rows, width)) + 0.3 * np.outer(rng.normal(size=rows), rng.normal(size=width))
    x -= x.mean(axis=0)
    found = leading_vectors(lambda q: x.T @ (x @ q) / rows, width)
    wanted = np.linalg.svd(x, full_matrices=False)[2][:2]
    assert np.allclose(np.abs(wanted @ found), np.eye(2), atol=1e-9)


def test_leading_vectors_of_a_single_direction():
    x = np.outer(np.arange(9.0) - 4, [1.0, 2.0, 0.0])
    found = leading_vectors(lambda q: x.T @ (x @ q), 3)
    assert np.allclose(np.abs(found[:, 0]), np.array([1, 2, 0]) / np.sqrt(5))
