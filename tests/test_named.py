from pathlib import Path

import pytest
from pyspark.sql import functions as F

from platewise.columns import PLATE, SITE, WELL
from platewise.operators.index import NUCLEI_X, NUCLEI_Y
from platewise.sinks import tables as K
from platewise.sinks.named import csv_header, csv_line, write_named_files


def files(folder):
    folder = Path(folder)
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".")}


def test_every_name_is_one_file_with_its_lines_in_order(spark, tmp_path):
    rows = [(f"d{i % 3}/f{i % 20}.txt", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "f string, i long").repartition(6)
    write_named_files(df, str(tmp_path), F.col("f"), F.col("i").cast("string"), [F.col("i").desc()], header="top")
    found = files(tmp_path)
    assert set(found) == {f for f, _ in rows}
    for name, text in found.items():
        wanted = sorted((i for f, i in rows if f == name), reverse=True)
        assert text == "top\n" + "".join(f"{i}\n" for i in wanted)


def test_files_are_replaced_and_others_stay(spark, tmp_path):
    def write(rows):
        df = spark.createDataFrame(rows, "f string, t string")
        write_named_files(df, str(tmp_path), F.col("f"), F.col("t"), [F.col("t")])

    write([("a", "1"), ("b", "2")])
    write([("b", "3"), ("c", None)])
    assert files(tmp_path) == {"a": "1\n", "b": "3\n", "c": "\n"}
    write([])
    assert len(files(tmp_path)) == 3


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    broken = F.when(F.col("id") == 77, F.raise_error(F.lit("bad row"))).otherwise(F.lit("x"))
    df = spark.range(200).select((F.col("id") % 5).cast("string").alias("f"), broken.alias("t"))
    with pytest.raises(Exception, match="bad row"):
        write_named_files(df.repartition(4), str(tmp_path / "out"), F.col("f"), F.col("t"), deal=True)
    assert files(tmp_path) == {}


@pytest.mark.parametrize("name", [None, "", "../up", "/root", "a//b", "_pending/x"])
def test_names_that_lead_elsewhere_raise(spark, tmp_path, name):
    df = spark.createDataFrame([(name, "t"), ("ok", "t")], "f string, t string")
    with pytest.raises(Exception, match="no name"):
        write_named_files(df, str(tmp_path / "out"), F.col("f"), F.col("t"))
    assert files(tmp_path) == {}


def test_csv_lines_read_back(spark, tmp_path):
    import pandas as pd

    rows = [("a,b", 'say "x"', 1.5), (" lead", None, None), ("plain", "", 2.0)]
    df = spark.createDataFrame(rows, "`x,1` string, y string, z double")
    K.write_csv_file(df, str(tmp_path), "t.csv", [F.col("`x,1`")])
    back = pd.read_csv(tmp_path / "t.csv")
    assert list(back.columns) == ["x,1", "y", "z"]
    assert sorted(back["x,1"]) == sorted(r[0] for r in rows)
    assert back.set_index("x,1").loc["a,b", "y"] == 'say "x"'
    assert csv_header(["a", 'b"c', "d,e"]) == 'a,"b""c","d,e"'
    assert df.select(csv_line(["z"]).alias("l")).collect()[0].l == "1.5"


def nuclei(spark, rows):
    return spark.createDataFrame(rows, f"{PLATE} string, {WELL} string, {SITE} string, {NUCLEI_X} long, {NUCLEI_Y} long")


def test_locations_have_the_names_of_their_sites(spark, tmp_path):
    rows = [("26159", "A02", "1", x, 10 - x) for x in (4, 2, 3)] + [("26159", "A02", "12", 1, 1), ("26160", "A02", "1", 7, 7)]
    K.write_locations(nuclei(spark, rows), str(tmp_path))
    head = f"{NUCLEI_X},{NUCLEI_Y}\n"
    assert files(tmp_path) == {
        "26159/A02-1-Nuclei.csv": head + "2,8\n3,7\n4,6\n",
        "26159/A02-12-Nuclei.csv": head + "1,1\n",
        "26160/A02-1-Nuclei.csv": head + "7,7\n",
    }
    before = files(tmp_path)
    K.write_locations(nuclei(spark, rows[::-1]).repartition(3), str(tmp_path))
    assert files(tmp_path) == before


def test_a_large_site_is_written_in_one_file_or_as_asked(spark, tmp_path):
    rows = [("p", "A01", "1" if i < 950 else "2", i, i) for i in range(1000)]
    K.write_locations(nuclei(spark, rows), str(tmp_path / "one"))
    assert set(files(tmp_path / "one")) == {"p/A01-1-Nuclei.csv", "p/A01-2-Nuclei.csv"}
    K.write_locations(nuclei(spark, rows), str(tmp_path / "many"), max_file_rows=100)
    found = files(tmp_path / "many")
    assert {n for n in found if "A01-2" in n} == {"p/A01-2-Nuclei.csv"}
    assert len(found) == 11 and "p/A01-1-Nuclei.csv" in found and "p/A01-1-Nuclei.9.csv" in found
    lines = [line for text in found.values() for line in text.splitlines()[1:]]
    assert sorted(int(line.split(",")[0]) for line in lines) == list(range(1000))


def test_chunks_have_a_table_and_a_list_each(spark, tmp_path):
    rows = [(p, w, s, f"{p}{w}_s{s}_w1.tif", None if s == 3 else f"{p}{w}_s{s}_w2.tif") for p in "PQ" for w in ("A01", "B01") for s in (1, 2, 3)]
    sets = spark.createDataFrame(rows, f"{PLATE} string, {WELL} string, {SITE} int, Image_FileName_OrigDNA string, Image_FileName_OrigMito string")
    assert K.write_chunks(sets.repartition(4), str(tmp_path / "c"), 4) == 4
    found = files(tmp_path / "c")
    assert set(found) == {f"{p}/chunk{i}.{e}" for p in "PQ" for i in (1, 2) for e in ("load_data.csv", "images.txt")}
    first = found["P/chunk1.load_data.csv"].splitlines()
    assert first[0] == ",".join(sets.columns)
    assert [line.split(",")[1:3] for line in first[1:]] == [["A01", "1"], ["A01", "2"], ["A01", "3"], ["B01", "1"]]
    names = found["P/chunk1.images.txt"].splitlines()
    assert names == sorted(set(names)) and len(names) == 7
    # One plate's chunks lie in the folder itself.
    assert K.write_chunks(sets.filter(f"{PLATE} = 'Q'"), str(tmp_path / "q"), 4, by_plate=False) == 2
    assert "chunk2.images.txt" in files(tmp_path / "q")
    assert K.write_chunks(sets.limit(0), str(tmp_path / "none"), 4) == 0


def test_lossless_write_finds_a_changed_value(spark, tmp_path):
    rows = [(1, "a", None, [1.0], {"k": 1}), (2, None, "a", [], {}), (2, None, "a", [], {})]
    schema = "i long, s string, t string, v array<double>, m map<string,int>"
    df = spark.createDataFrame(rows, schema)
    assert K.write_lossless(df, str(tmp_path / "ok")) == 3
    mine = K.row_digest(df)
    assert K.row_digest(df.repartition(3)) == mine
    changed = [
        [(1, "b", None, [1.0], {"k": 1}), *rows[1:]],
        [(1, None, "a", [1.0], {"k": 1}), *rows[1:]],
        [(1, "a", None, [1.0], {"k": 2}), *rows[1:]],
        [rows[0], rows[0], rows[1]],
    ]
    for other in changed:
        with pytest.raises(K.ContentMismatch):
            K.require_same_rows(mine, K.row_digest(spark.createDataFrame(other, schema)))
    with pytest.raises(K.RowCountMismatch):
        K.require_same_rows(mine, K.row_digest(df.limit(2)))
    assert K.write_lossless(df.limit(0), str(tmp_path / "none")) == 0
