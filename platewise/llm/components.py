"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.session import materialize


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component``, its smallest member, for every node but the smallest.

    ``edges`` has two long columns. A large star hangs the larger neighbours of a
    node on the smallest one, a small star the smaller ones; both keep the
    components. They alternate until every edge leads to its component's smallest
    node, after a number of rounds that grows with the logarithm of the size. Each
    round is written to the shared folder, so lineage stays short. A hub is an
    ordinary hot join key: its minimum combines before the shuffle and adaptive
    execution splits the join.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    stars = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    stars = materialize(stars.filter("hi > lo").distinct(), "edges")
    before = None
    while (mark := _mark(stars)) != before:
        before = mark
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            stars.select(F.col("lo"), F.col("hi"))
        )
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = materialize(large.distinct(), "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.union(least.select("hi", "m"))
        stars = materialize(small.distinct(), "small-star")
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
