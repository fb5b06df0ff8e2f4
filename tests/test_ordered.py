import random

import pytest
from pyspark.sql import functions as F

from platewise.operators.aggregate import aggregate_median, strata_order
from platewise.operators.index import index_order
from platewise.plans.aggregate import aggregate
from platewise.sinks.ordered import read_in_order, write_in_order


def test_positions_follow_the_keys_with_nulls_last(spark, tmp_path):
    draw = random.Random(1)
    rows = [(draw.choice([None, "a", "b", "c"]), draw.choice([None, *range(50)]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, n long, i long").repartition(7)
    path = write_in_order(df, str(tmp_path / "t"), [F.col(c).asc_nulls_last() for c in ("k", "n", "i")])
    found = [tuple(r) for r in read_in_order(spark, path).orderBy("position").collect()]
    last = "￿"
    wanted = sorted(rows, key=lambda r: (r[0] or last, r[1] if r[1] is not None else 99, r[2]))
    assert [r[:3] for r in found] == wanted
    assert [r[3] for r in found] == list(range(len(rows)))


def test_a_task_of_several_files_and_descending_order(spark, tmp_path):
    df = spark.range(1000).withColumn("text", F.lit("x"))
    path = write_in_order(df, str(tmp_path / "t"), [F.col("id").desc()], max_file_rows=90)
    assert len(list((tmp_path / "t").glob("*.parquet"))) > 10
    found = read_in_order(spark, path, "place").orderBy("place").collect()
    assert [(r.id, r.place) for r in found] == [(999 - i, i) for i in range(1000)]
    with pytest.raises(ValueError, match="column ID"):
        read_in_order(spark, path, "ID")


def test_rows_that_agree_in_the_first_keys_are_spread(spark, tmp_path):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_in_order(df, str(tmp_path / "t"), [F.col("k"), F.col("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "t").glob("*.parquet"))) > 1
    assert read_in_order(spark, path).filter("position <> id").count() == 0


def test_empty_table(spark, tmp_path):
    path = write_in_order(spark.range(0), str(tmp_path / "t"), [F.col("id")])
    assert read_in_order(spark, path).count() == 0


def test_medians_and_index_lie_in_order(spark, tmp_path):
    wells = [("b", "A2"), ("a", "A1"), (None, "A1"), ("a", None), ("b", "A1")]
    cells = spark.createDataFrame([(p, w, float(i)) for i in range(3) for p, w in wells], "p string, w string, Cells_x double")
    cells.write.parquet(str(tmp_path / "in"))
    aggregate(spark, str(tmp_path / "in"), str(tmp_path / "out"), strata=["p", "w"])
    found = read_in_order(spark, str(tmp_path / "out")).orderBy("position").collect()
    assert [(r.p, r.w) for r in found] == [("a", "A1"), ("a", None), ("b", "A1"), ("b", "A2"), (None, "A1")]
    # The order of the frame is that of the file.
    memory = aggregate_median(cells, ["p", "w"]).collect()
    assert [(r.p, r.w) for r in memory] == [(r.p, r.w) for r in found]
    assert len(strata_order(["p", "w"])) == 2
    sites = ["10", "2", "x", "1", None, "-1", "2.5"]
    index = spark.createDataFrame([("P", "A01", s, *"12345") for s in sites], "Metadata_Plate string, Metadata_Well string, Metadata_Site string, DNA string, RNA string, ER string, AGP string, Mito string")
    path = write_in_order(index, str(tmp_path / "index"), index_order())
    found = read_in_order(spark, path).orderBy("position").collect()
    assert [r.Metadata_Site for r in found] == ["-1", "1", "2", "2.5", "10", "x", None]
