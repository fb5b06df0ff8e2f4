"""Every query of the package: against its SQL where there is one, else against brute force."""

from pathlib import Path

import pytest

import check
from __spark_entry__ import queries
from platewise.llm import oracle
from platewise.llm import queries as llm

SF = "/root/testdata/sf0.001"
# Models are judged where more than a handful of labelled documents is held out.
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_all_operators_and_the_pipeline_are_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
    assert set(oracle.all_sql()) <= names


@pytest.mark.parametrize("name", sorted(oracle.all_sql()))
def test_against_sql(spark, con, name):
    assert check.compare(llm.all_queries()[name](spark, SF), con, oracle.all_sql()[name]) is None


@pytest.mark.parametrize("name", ["op1_language", "op5_quality"])
def test_models_on_documents_they_did_not_learn_from(spark, name):
    con = check.connect(LARGER)
    rows = llm.all_queries()[name](spark, LARGER).toPandas()
    documents = con.execute("SELECT doc_id, lang FROM documents").df()
    assert sorted(rows["doc_id"]) == sorted(documents["doc_id"])
    assert rows["score"].between(0, 1).all()
    held = rows[rows["held_out"]]
    if name == "op1_language":
        truth = held.merge(documents, on="doc_id")
        assert (truth["lang"] == truth["lang_pred"]).mean() > 0.95
    else:
        truth = held.merge(con.execute("SELECT doc_id, quality FROM labels").df(), on="doc_id")
        assert (truth["quality"] == truth["predicted"]).mean() > 0.9
        assert ((rows["score"] >= 0.3) == (rows["predicted"] == 1)).all()
