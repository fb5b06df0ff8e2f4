import sqlite3
from contextlib import closing

import numpy as np
import pandas as pd
import pytest

from platewise.operators.singlecell import cast_types
from platewise.plans.convert import convert_compartments, convert_embeddings
from platewise.sources import sqlite as Q
from platewise.sources.embeddings import embedding_width, read_npz


PARENTS = ("Cytoplasm_Parent_Cells", "Cytoplasm_Parent_Nuclei")
DECLARED = {"i": "INTEGER", "f": "REAL", "O": "TEXT"}


def store(path, tables):
    """Write data frames as SQLite tables, columns declared by their kind."""
    with closing(sqlite3.connect(path)) as con:
        for name, frame in tables.items():
            columns = ", ".join(f"{c} {DECLARED[frame[c].dtype.kind]}" for c in frame)
            con.execute(f"CREATE TABLE {name} ({columns})")
            marks = ", ".join("?" * len(frame.columns))
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", frame.astype(object).values.tolist())
        con.commit()


def make_sqlite(path, objects=3, compartments=("Cells", "Nuclei", "Cytoplasm"), well="A02"):
    """Two imaged sites; cytoplasm i of a site belongs to its nucleus i and to a cell counted from the end."""
    sites = pd.DataFrame({"ImageNumber": [7, 8]}).assign(Image_Metadata_Plate="runX", Image_Metadata_Well=well)
    sites["Image_Metadata_Well"] = sites["Image_Metadata_Well"].astype(object)
    sites["Image_Metadata_Plate"] = sites["Image_Metadata_Plate"].astype(object)
    grid = [(site, i) for site in (7, 8) for i in range(1, objects + 1)]
    number = pd.DataFrame(grid, columns=["ImageNumber", "ObjectNumber"], dtype="int64")
    tables = {"Per_Image": sites, "Per_Run": pd.DataFrame({"version": [3]})}
    for name in compartments:
        frame = number.assign(**{f"{name}_Area": number["ObjectNumber"] + number["ImageNumber"] / 100})
        if name == "Cytoplasm":
            frame = frame.assign(**{PARENTS[0]: objects + 1 - frame["ObjectNumber"], PARENTS[1]: frame["ObjectNumber"]})
        tables[f"Per_{name}"] = frame
    store(path, tables)


def test_compartments_are_joined_by_parent_and_empty_sources_skipped(spark, tmp_path):
    source = tmp_path / "measurement"
    (source / "deep").mkdir(parents=True)
    make_sqlite(source / "p.1.sqlite", 3)
    make_sqlite(source / "deep" / "p.2.sqlite", 2, well="B01")
    make_sqlite(source / "p.3.sqlite", 0)
    make_sqlite(source / "p.4.sqlite", 2, compartments=("Cells", "Nuclei"))
    result = convert_compartments(spark, str(source), str(tmp_path / "out"))
    assert [p.rsplit("/", 1)[1] for p in result.complete] == ["p.2.sqlite", "p.1.sqlite"]
    assert [p.rsplit("/", 1)[1] for p in result.incomplete] == ["p.3.sqlite", "p.4.sqlite"]
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {"Metadata_Plate", "Metadata_Well", "Metadata_ImageNumber"} <= set(out.columns)
    assert not [c for c in out.columns if c.startswith("Image_")]
    types = dict(out.dtypes)
    assert types["Cells_Area"] == "float" and types["Cytoplasm_Parent_Cells"] == "bigint"
    rows = out.where("Metadata_Well = 'A02'").orderBy("Metadata_ImageNumber", "Cytoplasm_ObjectNumber").collect()
    assert [round(r.Cytoplasm_Area, 2) for r in rows] == [1.07, 2.07, 3.07, 1.08, 2.08, 3.08]
    assert [round(r.Cells_Area, 2) for r in rows] == [3.07, 2.07, 1.07, 3.08, 2.08, 1.08]
    assert [round(r.Nuclei_Area, 2) for r in rows] == [1.07, 2.07, 3.07, 1.08, 2.08, 3.08]
    assert out.where("Metadata_Well = 'B01'").count() == 4


def test_nothing_is_written_when_all_sources_are_empty(spark, tmp_path):
    make_sqlite(tmp_path / "p.sqlite", 0)
    result = convert_compartments(spark, str(tmp_path / "p.sqlite"), str(tmp_path / "out"))
    assert not result.complete and not (tmp_path / "out").exists()
    with pytest.raises(FileNotFoundError):
        convert_compartments(spark, str(tmp_path / "none"), str(tmp_path / "out"))


def test_large_files_are_read_by_row_range(spark, tmp_path, monkeypatch):
    make_sqlite(tmp_path / "p.sqlite", 250)
    schema = Q.table_schema(Q.sqlite_files(spark, str(tmp_path)), "Per_Cells")
    shares = [Q.read_share(str(tmp_path / "p.sqlite"), i, 7, "Per_Cells", schema) for i in range(7)]
    counts = [sum(batch.num_rows for batch in share) for share in shares]
    assert sum(counts) == 500 and max(counts) - min(counts) <= 1
    monkeypatch.setattr(Q, "SPLIT_BYTES", 5000)
    assert Q.read_sqlite_table(spark, str(tmp_path), "Per_Cells").distinct().count() == 500


def sql(path, *statements):
    with closing(sqlite3.connect(path)) as con:
        for statement in statements:
            con.execute(statement)
        con.commit()


def test_declared_types_and_other_values(spark, tmp_path):
    sql(
        tmp_path / "a.sqlite",
        "CREATE TABLE t (i INTEGER, f REAL, s TEXT, n NUMERIC, d DECIMAL(8, 2), u, w)",
        "INSERT INTO t VALUES (1, 2, 'x', '2.5', 3, 4.5, 'word'), ('nan', 'inf', 5, 7, 8.25, 6, 1)",
        "INSERT INTO t VALUES (NULL, NULL, NULL, NULL, NULL, NULL, NULL)",
    )
    got = Q.read_sqlite_table(spark, str(tmp_path), "t").drop("source")
    assert [kind for _, kind in got.dtypes] == ["bigint", "double", "string", "double", "double", "double", "string"]
    assert [tuple(r) for r in got.collect()] == [
        (1, 2.0, "x", 2.5, 3.0, 4.5, "word"), (None, float("inf"), "5", 7.0, 8.25, 6.0, "1"), (None,) * 7,
    ]


@pytest.mark.parametrize("value, said", [("1.5", "declared whole"), ("'word'", "no number"), ("'inf'", "declared whole")])
def test_values_that_a_column_cannot_hold_raise(spark, tmp_path, value, said):
    sql(tmp_path / "a.sqlite", "CREATE TABLE t (i INTEGER)", f"INSERT INTO t VALUES ({value})")
    with pytest.raises(Exception, match=said):
        Q.read_sqlite_table(spark, str(tmp_path), "t").collect()


def test_files_with_other_columns_are_united(spark, tmp_path):
    sql(tmp_path / "a.sqlite", "CREATE TABLE t (i INTEGER, x INTEGER)", "INSERT INTO t VALUES (1, 2)")
    sql(tmp_path / "b.sqlite", "CREATE TABLE t (extra TEXT, x REAL)", "INSERT INTO t VALUES ('e', 0.5)")
    got = Q.read_sqlite_table(spark, str(tmp_path), "t").drop("source")
    assert got.dtypes == [("i", "bigint"), ("x", "double"), ("extra", "string")]
    assert sorted(map(repr, map(tuple, got.collect()))) == ["(1, 2.0, None)", "(None, 0.5, 'e')"]


def test_cast_map(spark):
    df = spark.createDataFrame([(1, 2.0)], "a bigint, b double")
    assert dict(cast_types(df).dtypes) == {"a": "bigint", "b": "float"}
    assert dict(cast_types(df, {"long": "int"}).dtypes) == {"a": "int", "b": "double"}
    assert cast_types(df, None).dtypes == df.dtypes


def test_npz_embeddings(spark, tmp_path):
    (tmp_path / "in" / "A02").mkdir(parents=True)
    for site in (1, 2):
        np.savez(
            tmp_path / "in" / "A02" / f"{site}.npz",
            features=np.arange(site * 3 * 4).reshape(-1, 4) + site,
            metadata=np.array([["Metadata_Well", "A02"], ["Metadata_Site", str(site)]]),
        )
    cells = read_npz(spark, str(tmp_path / "in"))
    assert (cells.count(), embedding_width(cells)) == (9, 4)
    names = {"Metadata_Well": "Metadata_Well", "Metadata_Site": "Metadata_Site"}
    rows = convert_embeddings(spark, str(tmp_path / "in"), str(tmp_path / "out"), metadata=names)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows == out.count() == 9
    first = out.where("Metadata_Site = '2' and cell = 1").first()
    assert [first[f"efficientnet_{i}"] for i in range(1, 5)] == [6.0, 7.0, 8.0, 9.0]
    assert first.Metadata_Well == "A02" and dict(out.dtypes)["efficientnet_1"] == "float"


def test_npz_with_a_dictionary_and_locations(spark, tmp_path):
    folder = tmp_path / "plateQ" / "C05"
    folder.mkdir(parents=True)
    np.savez(folder / "s2.npz", features=np.eye(3), metadata={"any": "thing"}, spots=np.arange(6.0).reshape(3, 2))
    np.savez(folder / "s3.npz", features=np.ones(3), metadata={"any": "thing"}, site=3)
    pattern = r"/(?P<Metadata_Plate>[^/]+)/(?P<Metadata_Well>[A-P][0-9]{2})/s(?P<Metadata_Site>[0-9]+)[.]npz$"
    for key in ("metadata", None):
        cells = read_npz(spark, str(tmp_path), metadata_key=key, path_pattern=pattern, locations_key="spots")
        rows = cells.orderBy("path", "cell").collect()
        about = {"Metadata_Plate": "plateQ", "Metadata_Well": "C05", "Metadata_Site": "2"}
        assert [r.metadata for r in rows[:3]] == [about] * 3
        assert [r.location for r in rows] == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0], None]
        assert rows[3].metadata == about | {"Metadata_Site": "3", "site": "3"}
    with pytest.raises(Exception, match="no plain array"):
        read_npz(spark, str(tmp_path), features_key="metadata").collect()


def test_conversion_keeps_metadata_by_default(spark, tmp_path):
    for well in ("C01", "C02"):
        (tmp_path / "in" / well).mkdir(parents=True)
        np.savez(tmp_path / "in" / well / "a.npz", features=np.ones((2, 3)), metadata={"x": 1}, batch=4)
    pattern = r"/(?P<Metadata_Well>[A-P][0-9]{2})/"
    convert_embeddings(spark, str(tmp_path / "in"), str(tmp_path / "out"), path_pattern=pattern)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.Metadata_Well, r.Metadata_batch) for r in rows) == [("C01", "4")] * 2 + [("C02", "4")] * 2
