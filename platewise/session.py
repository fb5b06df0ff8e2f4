"""Session set-up and durable intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side, in rows, that is sent to every executor; wider keys get other joins.
BROADCAST_ROWS = 200_000
# Rows of a table of keys that the driver may hold.
FEW_ROWS = 1_000


def build_session(app: str = "platewise", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Joins may keep a partitioning by some of their keys; see join_compartments.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster for intermediate tables.

    ``spark.checkpoint.dir`` names it. Where it is unset, a session of one machine
    takes a temporary folder, and a cluster a folder beside its warehouse, if that lies
    in a store that all machines share. A folder of each machine's own would do for none.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if re.match(r"local(\[|$)", spark.sparkContext.master):
        folder = tempfile.mkdtemp(prefix="platewise-")
    else:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if re.match(r"(file:|/)", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = warehouse + "-intermediate"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for one intermediate table."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result is computed once, survives lost executors and, being parquet,
    still prunes columns and pushes filters down.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Mark a join side for broadcast when its counted size allows it.

    Otherwise the join is left to Spark: a shuffle join whose skewed
    partitions adaptive execution splits.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def settled(df: DataFrame, label: str = "table") -> tuple[DataFrame, int]:
    """A table of keys, computed once, and its number of rows.

    Up to ``FEW_ROWS`` rows become a local table, in one job; more are written out.
    """
    found = df.limit(FEW_ROWS + 1).toArrow()
    if found.num_rows <= FEW_ROWS:
        return df.sparkSession.createDataFrame(found, df.schema), found.num_rows
    written = materialize(df, label)
    return written, written.count()
