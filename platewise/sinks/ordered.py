"""Tables that keep the order of their rows on disk.

Rows are range partitioned and sorted, and a task writes its range to files of its own
task number. The order is then that of the files by task number and of the rows in each,
which a reader can tell from the row's file and place; nothing is stored with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.session import materialize, small_side

POSITION = "position"
# Fixed by Spark's file names: the task and, where a task writes several files, the file's number.
_TASK, _NUMBER = r"part-([0-9]+)-", r"-c([0-9]+)\b"
_FILE, _ROW, _SHIFT = "__file", "__row", "__shift"


def write_in_order(df: DataFrame, path: str, order: Sequence[Column], *, max_file_rows: int = 0) -> str:
    """Write parquet whose files, by task number, hold the rows in the order of ``order``.

    The sort keys are dealt out by ranges, so rows that agree in all of them are in one
    task: give as many keys as tell the rows apart where very many could agree.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").option("maxRecordsPerFile", max_file_rows).parquet(path)
    return path


def _file_order() -> list[Column]:
    name = F.col(_FILE)
    numbers = [F.try_to_number(F.nullif(F.regexp_extract(name, p, 1), F.lit("")), F.lit("9" * 18)) for p in (_TASK, _NUMBER)]
    return [*[n.asc_nulls_last() for n in numbers], name.asc()]


def read_in_order(spark: SparkSession, path: str, alias: str = POSITION) -> DataFrame:
    """The rows of ``write_in_order`` with their 0-based place in the order.

    The counts of the files, one row each, give what lies before a file; the reader gives
    the place inside it. No row is sorted or shuffled.
    """
    stored = spark.read.parquet(path)
    if alias.lower() in {c.lower() for c in stored.columns}:
        raise ValueError(f"the table has a column {alias}; name the position otherwise")
    held = spark.read.parquet(path).select(F.col("_metadata.file_path").alias(_FILE))
    sizes = held.groupBy(_FILE).agg(F.count("*").alias(_SHIFT))
    before = Window.orderBy(*_file_order()).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(_FILE, F.coalesce(F.sum(_SHIFT).over(before), F.lit(0)).alias(_SHIFT))
    shifts = materialize(shifts, "files-in-order")
    placed = stored.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    joined = placed.join(small_side(shifts, shifts.count()), _FILE)
    return joined.withColumn(alias, F.col(_ROW) + F.col(_SHIFT)).drop(_FILE, _ROW, _SHIFT)
