"""Exact deduplication over an extendible-hash index in the shared folder."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import lower_ascii, spare_name, whole_text
from platewise.session import materialize, small_side

# Buckets that the average shuffle partition owns, and the least rows of a bucket.
BUCKETS_PER_TASK = 8
LEAST_CAPACITY = 128
# The directory has at most 2**20 slots.
MAX_DEPTH = 20


def directory_depths(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Local depth of the bucket that each slot of the directory points to.

    ``counts`` has the rows of each slot, a power of two of them in hash order. The
    index starts as one bucket. A bucket over its capacity splits on the next bit
    of the hash; when its depth is the directory's, the directory doubles. Slots
    whose bucket is not split further share it.
    """
    depth = int(math.log2(len(counts)))
    local = np.zeros(len(counts), dtype=np.int32)
    for level in range(depth):
        width = len(counts) >> level
        overfull = counts.reshape(-1, width).sum(axis=1) > capacity
        local[np.repeat(overfull, width) & (local == level)] = level + 1
    return local


def build_directory(keys: DataFrame, rows: int, capacity: int) -> tuple[DataFrame, int]:
    """The directory as a table (``slot``, ``bucket``, ``depth``) and its global depth.

    The slots' row counts, at most ``2**MAX_DEPTH`` numbers, are all that the
    driver sees. Keys with more rows than a bucket takes are left out: no split
    separates equal keys, they overflow into pages of their own.
    """
    depth = min(MAX_DEPTH, max(1, math.ceil(math.log2(max(2, rows / capacity))) + 4))
    slot = F.shiftrightunsigned(F.col("key"), 64 - depth).alias("slot")
    found = keys.filter(F.col("n") <= capacity).groupBy(slot).agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << depth, dtype=np.int64)
    for row in found:
        counts[row["slot"]] = row["n"]
    local = directory_depths(counts, capacity)
    slots = np.arange(1 << depth)
    buckets = slots >> (depth - local) << (depth - local)
    spark = keys.sparkSession
    table = spark.createDataFrame(
        list(zip(slots.tolist(), buckets.tolist(), local.tolist())),
        "slot long, bucket long, depth int",
    )
    return table, depth


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int | None = None,
) -> DataFrame:
    """One row a document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A to Z; null counts as
    empty. The largest id of a group stays.

    Rows are filed by the first bits of their text's 64-bit hash. The directory
    doubles until no bucket is overfull; copies of one text, which no bit
    separates, chain into pages of ``capacity`` rows. A task owns whole buckets
    and pages, so it sees every row of its key ranges; it chains the rows of a hash
    and compares their bytes, and files one index entry a text. Pages of one key
    are merged by digest. The index lies in the shared folder.

    ``capacity`` is by default an eighth of an even share of the rows, 128 at
    least, which bounds the directory by the number of shuffle partitions.

    A null id is no candidate to stay: a group of such rows alone has a null
    ``keep_id`` and all its rows count as kept. Repeated rows with the id that
    stays are the same document and count as kept. Other columns are not read.
    """
    spark = docs.sparkSession
    text = lower_ascii(whole_text(text_col))
    entries = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("norm")).withColumn(
        "key", F.xxhash64("norm")
    )
    filed = entries.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256"))
    filed = materialize(filed, "dedup-rows")
    rows = filed.count()
    if capacity is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        capacity = max(LEAST_CAPACITY, math.ceil(rows / (tasks * BUCKETS_PER_TASK)))
    keys = materialize(filed.groupBy("key").agg(F.count("*").alias("n")), "dedup-keys")
    directory, depth = build_directory(keys, rows, capacity)
    # At most rows / capacity keys have more rows than capacity: both sides are small by proof.
    heavy = keys.filter(F.col("n") > capacity).select(
        "key", F.ceil(F.col("n") / capacity).alias("pages")
    )
    slot = F.shiftrightunsigned(F.col("key"), 64 - depth)
    page = F.pmod(F.monotonically_increasing_id(), F.col("pages"))
    dealt = (
        entries.withColumn("slot", slot)
        .join(F.broadcast(directory), "slot")
        .join(F.broadcast(heavy), "key", "left")
        .withColumn("page", page)
        .withColumn("chain", F.when(F.col("pages").isNotNull(), F.col("key")))
        .select("bucket", "depth", "chain", "page", "key", "norm", "doc_id")
        .repartition("bucket", "chain", "page")
    )
    # The owner's hash table chains the rows of a hash and compares bytes; no shuffle follows.
    chains = dealt.groupBy("bucket", "chain", "page", "key", "norm", "depth").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("n")
    )
    index = materialize(
        chains.select(
            "bucket", "depth", "page", "key", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "n"
        ),
        "dedup-index",
    )
    groups = (
        index.groupBy("key", "text_sha256")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .filter("group_size > 1")
    )
    groups = materialize(groups, "dedup-groups")
    # At most rows / capacity groups are that large. They are sent to the rows, so that no
    # task gathers all copies of a text; the other groups are joined by key.
    same = ["key", "text_sha256"]
    large = F.broadcast(groups.filter(F.col("group_size") > capacity))
    small = groups.filter(F.col("group_size") <= capacity)
    joined = (
        filed.join(large, same, "left_anti")
        .join(small, same, "left")
        .unionByName(filed.join(large, same))
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; one of repeated rows.

    Only rows to drop are joined back, on id and digest. Rows that share both id and
    text are thinned to one, which needs no shuffle of texts where there are none.
    """
    verdict = exact_dedup(docs, id_col, text_col)
    verdict = materialize(verdict, "dedup-verdict")
    digest = F.sha2(lower_ascii(whole_text(text_col)), 256)
    sha = spare_name(docs, "__sha")
    gone = verdict.filter("not kept").select("doc_id", "text_sha256").distinct()
    gone = small_side(gone, gone.count())
    marked = docs.withColumn(sha, digest)
    same = marked[id_col].eqNullSafe(gone["doc_id"]) & (marked[sha] == gone["text_sha256"])
    left = marked.join(gone, same, "left_anti")
    repeated = verdict.filter("kept").groupBy("doc_id", "text_sha256").count().filter("count > 1")
    if not repeated.isEmpty():
        left = left.dropDuplicates([id_col, sha])
    return left.drop(sha)
