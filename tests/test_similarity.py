import numpy as np
import pytest

from platewise.columns import COMPOUND
from platewise.operators import similarity as S
from platewise.operators.features import InsufficientData, feature_table


@pytest.fixture
def consensus(cohort):
    return cohort(plates=1, wells=20, compounds=20, features=15).drop(columns=["Metadata_Plate", "Metadata_Well"])


def table_of(spark, frame):
    return feature_table(spark.createDataFrame(frame), [COMPOUND])


def distances(frame, reference):
    x = frame.set_index(COMPOUND)
    return np.sqrt(((x - reference) ** 2).sum(axis=1))


def test_activity_and_order(spark, consensus):
    active = S.activity(table_of(spark, consensus))
    want = distances(consensus, consensus.set_index(COMPOUND).loc["DMSO"]).drop("DMSO")
    got = S.most_active(active, [COMPOUND], 5).collect()
    top = want.sort_values(ascending=False).head(5)
    assert [r[COMPOUND] for r in got] == list(top.index)
    np.testing.assert_allclose([r.activity for r in got], top)
    everyone = S.most_active(active, [COMPOUND], 0).collect()
    assert len(everyone) == 20 and everyone[-1][COMPOUND] == "DMSO"


def test_without_control_the_reference_is_zero(spark, consensus):
    got = S.activity(table_of(spark, consensus), control="water").collect()
    want = distances(consensus, 0.0)
    for row in got:
        assert row.activity == pytest.approx(want[row[COMPOUND]])


@pytest.mark.parametrize("block_rows", [2048, 4])
def test_correlation_matrix(spark, consensus, block_rows):
    frame = consensus.copy()
    frame.loc[4, frame.columns[1:]] = 2.5  # no variance
    table = table_of(spark, frame)
    got = S.similarity(table, COMPOUND, block_rows=block_rows).toPandas()
    assert len(got) == 400
    matrix = got.pivot(index="left", columns="right", values="r").to_numpy()
    ordered = frame.sort_values(COMPOUND).set_index(COMPOUND).to_numpy()
    with np.errstate(invalid="ignore"):
        np.testing.assert_allclose(matrix, np.corrcoef(ordered), atol=1e-12)


def test_top_selection_and_guard(spark, consensus):
    assert S.compound_similarity(table_of(spark, consensus), top_n=3).count() == 9
    with pytest.raises(InsufficientData):
        S.compound_similarity(table_of(spark, consensus), top_n=1)
