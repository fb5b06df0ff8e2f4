"""Mixing sources to target weights with Pfair windows and earliest deadline first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from platewise.llm.common import spare_name

BLOCK_ROWS = 16
SEED = "mix"
# Hexadecimal digits of the hash that tell a source's bins apart.
BIN_DIGITS = 3

# One row holds the sources (quota list ``a``, block list ``n``). Round r gives source s its next
# a[s] blocks, or what is left of it. Rounds with equal quotas share a schedule, so only the first
# round after a change is worked out: at most two a source.
_ERAS = """
SELECT a, n, start, lead(start) OVER (ORDER BY start) AS stop
FROM (
  SELECT a, n, explode(array_distinct(concat(array(0L), flatten(
    transform(a, (w, s) -> array(n[s] div w, n[s] div w + 1)))))) AS start
  FROM {sources})
"""

_QUOTAS = """
SELECT start, stop, a, n, quota, aggregate(quota, 0L, (x, q) -> x + q) AS size
FROM (
  SELECT *, transform(a, (w, s) -> greatest(0L, least(w, n[s] - w * start))) AS quota
  FROM {eras})
"""

# Block i of a source with quota q in a round of L slots may run from slot floor(i L / q) on and must
# be done by ceil((i + 1) L / q). Each slot takes, of the blocks that may run, the one due first.
_SLOTS = """
SELECT start, stop, a, n, aggregate(
  sequence(0L, size - 1),
  named_struct(
    'next', transform(quota, q -> 0L),
    'slots', cast(array() AS array<struct<
      deadline: bigint, source: int, i: bigint, release: bigint, slot: bigint>>)),
  (state, t) -> transform(
    array(array_min(filter(
      transform(quota, (q, s) -> named_struct(
        'deadline', ((state.next[s] + 1) * size + q - 1) div greatest(q, 1L),
        'source', s,
        'i', state.next[s],
        'release', (state.next[s] * size) div greatest(q, 1L))),
      x -> x.i < quota[x.source] AND x.release <= t))),
    best -> named_struct(
      'next', transform(state.next, (i, s) -> IF(s = best.source, i + 1, i)),
      'slots', concat(state.slots, array(named_struct(
        'deadline', best.deadline, 'source', best.source, 'i', best.i,
        'release', best.release, 'slot', t)))))[0],
  state -> state.slots) AS slots
FROM {quotas}
WHERE size > 0
"""

_TEMPLATE = """
SELECT start, stop, a, n, e.source AS number, e.i, e.release, e.deadline, e.slot
FROM (SELECT start, stop, a, n, explode(slots) AS e FROM {slots})
"""


def _weights(weights: Mapping[str, int], other: int) -> list[int]:
    found = [*weights.values(), other]
    if any(int(w) != w or w < 1 for w in found):
        raise ValueError("weights are whole numbers from 1 on")
    return [int(w) for w in found]


def _hashed(rows: DataFrame, weights: Mapping[str, int], seed: str) -> DataFrame:
    """Add the number of the source and the keyed hash of the id that shuffles its rows."""
    part = F.lit(len(weights))
    for number, name in enumerate(weights):
        part = F.when(F.col("source").eqNullSafe(F.lit(name)), number).otherwise(part)
    # Rows without id get a key of their own, else they would all share a place.
    number = F.concat(F.lit("row "), F.monotonically_increasing_id())
    key = F.coalesce(F.col("id").cast("string"), number)
    order = F.md5(F.concat_ws(":", F.lit(seed), key))
    hashed = rows.withColumns({"part": part, "order": order})
    return hashed.withColumn("bin", F.substring("order", 1, BIN_DIGITS))


def _template(bins: DataFrame, weights: list[int], block_rows: int) -> DataFrame:
    """The slots of a round's blocks, for every run of rounds with equal quotas."""
    spark = bins.sparkSession
    blocks = F.ceil(F.sum("rows") / block_rows).cast("long").alias("blocks")
    by_part = bins.groupBy("part").agg(blocks)
    # One row with a number a source: the list of sources is a parameter.
    found = by_part.agg(F.map_from_entries(F.collect_list(F.struct("part", "blocks"))).alias("by"))
    zero = F.lit(0).cast("long")
    sources = found.select(
        F.array(*[F.lit(w).cast("long") for w in weights]).alias("a"),
        F.array(
            *[F.coalesce(F.try_element_at("by", F.lit(s)), zero) for s in range(len(weights))]
        ).alias("n"),
    )
    eras = spark.sql(_ERAS, sources=sources)
    quotas = spark.sql(_QUOTAS, eras=eras)
    slots = spark.sql(_SLOTS, quotas=quotas)
    return spark.sql(_TEMPLATE, slots=slots)


def _scheduled(
    rows: DataFrame, weights: Mapping[str, int], other: int, block_rows: int, seed: str
) -> DataFrame:
    """``rows`` has ``id``, ``source`` and whatever is carried along.

    A source's rows are numbered in bins of their hash; a bin starts where the bins
    before it end, so a source with a third of all rows is thousands of groups.
    """
    quotas = _weights(weights, other)
    hashed = _hashed(rows, weights, seed)
    bins = hashed.groupBy("part", "bin").agg(F.count("*").alias("rows"))
    before = W.partitionBy("part").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift")
    inside = W.partitionBy("part", "bin").orderBy("order", "id")
    # At most 16**BIN_DIGITS bins a source, and (2 sources + 1) rounds of sum(weights) slots.
    shifts = F.broadcast(bins.select("part", "bin", shift))
    template = F.broadcast(_template(bins, quotas, block_rows))
    placed = (
        hashed.withColumn("rank", F.row_number().over(inside) - 1)
        .join(shifts, ["part", "bin"])
        .withColumn("rank", F.col("rank") + F.col("shift"))
        .withColumn("quota", F.element_at(F.array(*[F.lit(w) for w in quotas]), F.col("part") + 1))
        .withColumn("block", F.expr(f"rank div {block_rows}"))
        .withColumn("place", (F.col("rank") % block_rows).cast("int"))
        .withColumn("round", F.expr("block div quota"))
        .withColumn("turn", F.col("block") % F.col("quota"))
    )
    same = (
        (placed["part"] == template["number"])
        & (placed["turn"] == template["i"])
        & (placed["round"] >= template["start"])
        & (template["stop"].isNull() | (placed["round"] < template["stop"]))
    )
    # Slots of the whole rounds before, and of the rounds like this one since the first of its kind.
    earlier = "aggregate(zip_with(a, n, (w, b) -> least(b, w * round)), 0L, (x, y) -> x + y)"
    out = placed.join(template, same).withColumn("earlier", F.expr(earlier))
    return out.withColumns({c: F.col(c) + F.col("earlier") for c in ("slot", "release", "deadline")})


def mix_order(
    docs: DataFrame,
    weights: Mapping[str, int],
    other: int,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    seed: str = SEED,
) -> DataFrame:
    """One row a document: ``doc_id``, ``source``, ``block``, ``release``, ``deadline``, ``slot``, ``place``.

    Sorting by ``slot``, then ``place``, gives the mix. ``weights`` are whole numbers;
    sources that it does not name, null included, share ``other``. Rows of a source
    come in an order drawn by ``seed`` and form blocks of ``block_rows``. A round
    holds as many blocks of each source as its weight says. Within a round block i
    of q may run from slot floor(i L / q) and is due by ceil((i + 1) L / q) of L
    slots; of the blocks that may run, the one due first takes the slot (equal: the
    source named first). So at every slot each source is less than one block from
    its exact share. When a source runs out the others go on at their weights, and
    no row is left out.

    Rows without id are ordered by their place in the input. Equal ids share a place
    in the order in any way. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"))
    return _scheduled(rows, weights, other, block_rows, seed).select(
        F.col("id").alias("doc_id"), "source", "block", "release", "deadline", "slot", "place"
    )


def mixed(
    docs: DataFrame,
    weights: Mapping[str, int],
    other: int,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    seed: str = SEED,
) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mix: file by file, row by row."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
    )
    placed = _scheduled(rows, weights, other, block_rows, seed).select("row", "slot", "place")
    ordered = placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return ordered.select("row.*")


def in_written_order(docs: DataFrame, place_col: str) -> DataFrame:
    """Add each row's place, from 0, in the files that ``docs`` reads, and sort by it.

    Part files count in order of name, rows in order of the file. A scan alone keeps
    no order: it deals out files by size.
    """
    file, row = spare_name(docs, "file"), spare_name(docs, "row")
    metadata = docs.metadataColumn("_metadata")
    rows = docs.withColumns({file: metadata["file_name"], row: metadata["row_index"]})
    # One row a file: names of more than 100,000 parts are longer.
    before = W.orderBy(F.length(file), file).rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("count").over(before), F.lit(0)).alias(place_col)
    shifts = rows.groupBy(file).count().select(file, shift)
    placed = rows.join(F.broadcast(shifts), file).withColumn(place_col, F.col(place_col) + F.col(row))
    return placed.drop(file, row).repartitionByRange(place_col).sortWithinPartitions(place_col)
