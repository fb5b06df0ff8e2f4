import numpy as np
import pandas as pd
import pytest

from platewise.operators.ranking import category_ranks, with_chunk_number, with_row_number


def test_row_number_of_a_hot_group_over_many_partitions(spark):
    rng = np.random.default_rng(0)
    order = rng.permutation(2000)
    frame = pd.DataFrame({"g": np.where(order % 10 < 7, "hot", order.astype(str)), "v": order})
    got = with_row_number(spark.createDataFrame(frame).repartition(5), ["g"], ["v"], "n").toPandas()
    want = frame.assign(n=frame.groupby("g").v.rank().astype(int) - 1)
    merged = got.merge(want, on=["g", "v"])
    assert len(merged) == 2000 and (merged.n_x == merged.n_y).all()


def test_nulls_come_last_and_null_is_a_group(spark):
    df = spark.createDataFrame([(None, 2), (None, None), (None, 1), ("a", 5)], "g string, v int")
    got = {(r.g, r.v): r.n for r in with_row_number(df, ["g"], ["v"], "n").collect()}
    assert got == {(None, 1): 0, (None, 2): 1, (None, None): 2, ("a", 5): 0}


def test_chunks_are_consecutive_and_the_last_is_short(spark):
    df = spark.createDataFrame([("p", i) for i in range(7)], "g string, v int")
    got = with_chunk_number(df, 3, ["g"], ["v"]).orderBy("v").collect()
    assert [r.chunk for r in got] == [1, 1, 1, 2, 2, 2, 3]
    with pytest.raises(ValueError):
        with_chunk_number(df, 0, ["g"], ["v"])


def test_category_ranks(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "label string")
    assert {r.label: r["rank"] for r in category_ranks(df, "label").collect()} == {"a": 0, "b": 1, "c": 2}
