"""Exact top-k inner products by a dual-tree search over cover trees."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from platewise.llm.common import map_arrow
from platewise.session import materialize

K, SCALE = 10, 1024
# Rows of the sample that gives the top of the trees and the first bounds, and the net drawn from it.
SAMPLE_ROWS, PIVOTS = 4096, 48
# Rows of a block of data, of a block of queries, and of the queries that meet a block in one group.
DATA_ROWS, QUERY_ROWS, GROUP_QUERIES = 4096, 256, 8192
LEAF_ROWS = 64
# A child of a cover tree covers this part of its parent's radius.
SHRINK = 0.7
# Whole numbers up to this are exact as doubles, and so are products that stay below it.
EXACT = 1 << 53


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component, a whole number as double; null for vectors with
    null or non-finite ones, or with one that ``scale`` makes infinite."""
    wide = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    bad = F.exists(
        wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    # Doubles from 2 ** 53 on are whole numbers already.
    whole = F.transform(wide, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, whole)


def exact_scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: doubles where they are exact, else Python's integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * queries.shape[1]
    if most < EXACT:
        return queries @ data.T
    left, right = ([[int(x) for x in row] for row in m.tolist()] for m in (queries, data))
    return np.array(left, dtype=object) @ np.array(right, dtype=object).T


def _at_most(score: int | float) -> float:
    """A double that is not above the score."""
    try:
        found = float(score)
    except OverflowError:
        return float(np.finfo(np.float64).max) if score > 0 else -math.inf
    return math.nextafter(found, -math.inf) if found > score else found


def _score_key(score: int) -> tuple[int | None, int, str | None]:
    """A score as a long, where one holds it, and what orders those that none holds."""
    if -(1 << 63) <= score < 1 << 63:
        return int(score), 0, None
    digits = str(abs(score))
    if score > 0:
        return None, 1, f"{len(digits):06d}{digits}"
    turned = digits.translate(str.maketrans("0123456789", "9876543210"))
    return None, -1, f"{999999 - len(digits):06d}{turned}"


@dataclass
class Node:
    """Points of a cover tree: all lie within ``radius`` of ``centre``."""

    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list["Node"] = field(default_factory=list)

    @property
    def norm(self) -> float:
        return float(np.sqrt(self.centre @ self.centre))


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, first: int | None = None) -> Node:
    """The tree over the points; a parent's centre is the first child's centre too.

    Centres of the children are a net: the farthest point from those chosen joins
    until all points are within the children's scale, so centres are farther apart
    than that scale and every point is covered. Points go to their nearest centre.
    A node whose net would need nearly all its points stays a leaf.
    """
    rows = np.arange(len(points)) if rows is None else rows
    own = points[rows]
    start = rows[0] if first is None else first
    distance = np.sqrt(np.maximum(((own - points[start]) ** 2).sum(axis=1), 0))
    node = Node(points[start], float(distance.max()), rows)
    # Distances that overflow tell nothing apart.
    if len(rows) <= LEAF_ROWS or node.radius == 0 or not math.isfinite(node.radius):
        return node
    scale, centres, nearest = SHRINK * node.radius, [start], np.zeros(len(rows), dtype=np.int64)
    while distance.max() > scale:
        if len(centres) * 8 > len(rows):
            return node
        centre = rows[int(np.argmax(distance))]
        away = np.sqrt(np.maximum(((own - points[centre]) ** 2).sum(axis=1), 0))
        closer = away < distance
        nearest[closer], distance[closer] = len(centres), away[closer]
        centres.append(centre)
    for number, centre in enumerate(centres):
        node.children.append(cover_tree(points, rows[nearest == number], centre))
    return node


def bound(a: Node, b: Node) -> float:
    """No inner product of a point of one node with a point of the other is larger."""
    most = float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
    most += 1e-9 * abs(most) + 1e-6
    return math.inf if math.isnan(most) else most


class Best:
    """The k best candidates of each query so far; equal scores go to the smaller id."""

    def __init__(self, queries: np.ndarray, floors: np.ndarray, k: int):
        self.ids, self.k = queries, k
        # A query's kth score so far, or what the sample says it is at least.
        self.floors = floors.astype(np.float64)
        self.found: list[list[tuple[int, int]]] = [[] for _ in queries]

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        heap = self.found[query]
        for score, id_ in zip(scores.tolist(), ids.tolist()):
            item = (score, -id_)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
        if len(heap) == self.k:
            self.floors[query] = max(self.floors[query], _at_most(heap[0][0]))


def dual_search(
    queries: Node, data: Node, query_points: np.ndarray, data_points: np.ndarray, data_ids: np.ndarray, best: Best
) -> None:
    """Walk pairs of nodes, the most promising first; a pair ends when its bound is below the worst kth score."""
    count = 0
    agenda = [(-bound(queries, data), count, queries, data)]
    while agenda:
        most, _, q, d = heapq.heappop(agenda)
        if -most < best.floors[q.rows].min():
            continue
        if not q.children and not d.children:
            scores = exact_scores(query_points[q.rows], data_points[d.rows])
            good = scores >= best.floors[q.rows][:, None]
            good &= data_ids[d.rows][None, :] != best.ids[q.rows][:, None]
            for i in np.nonzero(good.any(axis=1))[0]:
                found = scores[i, good[i]]
                found = found if found.dtype == object else found.astype(np.int64)
                best.offer(int(q.rows[i]), found, data_ids[d.rows[good[i]]])
            continue
        split_query = q.children and (not d.children or q.radius >= d.radius)
        pairs = [(c, d) for c in q.children] if split_query else [(q, c) for c in d.children]
        for a, b in pairs:
            limit = bound(a, b)
            if limit >= best.floors[a.rows].min():
                count += 1
                heapq.heappush(agenda, (-limit, count, a, b))


def _net(sample: np.ndarray, size: int) -> np.ndarray:
    """Points of the sample that lie far apart: the farthest from those chosen, again and again."""
    chosen = [0]
    distance = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(size, len(sample)) and distance.max() > 0:
        chosen.append(int(np.argmax(distance)))
        distance = np.minimum(distance, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _block(points: np.ndarray, ids: np.ndarray) -> dict:
    centre = points.mean(axis=0)
    return {
        "ids": ids.astype(np.int64).tobytes(),
        # Four bytes a component where they do.
        "points": points.astype(np.int32 if np.abs(points).max() < 1 << 31 else np.float64).tobytes(),
        "centre": centre.tolist(),
        "norm": float(np.linalg.norm(centre)),
        "radius": float(np.sqrt(((points - centre) ** 2).sum(axis=1).max())),
    }


def _points(held: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.int32 if len(held) == 4 * rows * dim else np.float64
    return np.frombuffer(held, dtype=kind).reshape(rows, dim).astype(np.float64)


_BLOCK = "block long, dim int, ids binary, points binary, centre array<double>, norm double, radius double"


def top_k(
    vectors: DataFrame,
    queries: Column | None = None,
    k: int = K,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of largest inner product for each query row: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Components count as ``floor(scale * x)``. ``queries`` says which rows ask, by
    default those whose id is divisible by 100; a row is no candidate of its own id.
    Equal scores go to the smaller id, and a query with fewer candidates gets all.

    Queries and data share the top of one cover tree, a net of ``PIVOTS`` points of a
    bounded sample, and lie in blocks of one of its cells. A block has a centre and a
    covering radius. The sample also gives every query a score that its kth reaches
    at least. A pair of blocks is dropped when no inner product can reach the
    lowest of those scores among its queries; the others meet in groups of one data
    block and a bounded number of queries, each searched tree against tree.

    Rows without id, with a null vector or a null or non-finite component take no
    part; nor do empty vectors. Only vectors of one length are compared. Of rows
    with one id each is a candidate, but a query is answered once, for its smallest
    vector. Large components are multiplied as whole numbers; a score that no long holds
    keeps its rank and is null. No queries or no rows give no rows.
    """
    vec_id = F.col(f"`{id_col}`").cast("long")
    rows = vectors.select(vec_id.alias("vec_id"), scaled(F.col(f"`{vector_col}`"), scale).alias("v"))
    asks = queries if queries is not None else F.col("vec_id") % 100 == 0
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.withColumn("asks", F.coalesce(asks, F.lit(False)))
    drawn = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(SAMPLE_ROWS).toPandas()
    samples: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for dim, part in drawn.groupby(drawn["v"].map(len)):
        points = _stack(part["v"])
        samples[int(dim)] = part["vec_id"].to_numpy(), points, _net(points, PIVOTS)

    def place(batch: pa.RecordBatch) -> Iterator[dict]:
        cells = []
        for vector in batch.column(2).to_pylist():
            point = np.asarray(vector, dtype=np.float64)
            if (found := samples.get(len(point))) is None:
                cells.append(0)
            else:
                cells.append(int(np.argmin(((found[2] - point) ** 2).sum(axis=1))))
        yield {
            "vec_id": batch.column(0), "asks": batch.column(1), "v": batch.column(2),
            "dim": [len(v) for v in batch.column(2)], "cell": cells,
        }

    schema = "vec_id long, asks boolean, v array<double>, dim int, cell int"
    placed = materialize(map_arrow(rows.select("vec_id", "asks", "v"), place, schema), "vectors")
    data = _pack(placed, DATA_ROWS, k, {})
    asking = placed.filter("asks").groupBy("vec_id").agg(F.min(F.struct("dim", "v", "cell")).alias("r"))
    asking = asking.select("vec_id", F.lit(True).alias("asks"), "r.v", "r.dim", "r.cell")
    floors = {dim: (ids, points) for dim, (ids, points, _) in samples.items()}
    query = _pack(asking, QUERY_ROWS, k, floors)

    small = ("dim", "block", "centre", "norm", "radius")
    d = data.select(*[F.col(c).alias(f"d_{c}") for c in small])
    q = query.select(*[F.col(c).alias(f"q_{c}") for c in small], "floor")
    product = F.aggregate(F.zip_with("q_centre", "d_centre", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    most = product + F.expr("q_norm * d_radius + d_norm * q_radius + q_radius * d_radius")
    # Every block of the stated queries against every block of the data, but for what the radii exclude.
    pairs = d.join(q, d["d_dim"] == q["q_dim"]).filter(most + F.abs(most) * 1e-9 + 1e-6 >= F.col("floor"))
    parts = max(1, math.ceil(asking.count() / GROUP_QUERIES))
    pairs = pairs.select(
        F.col("d_block"), F.col("q_block"), F.pmod(F.hash("q_block"), F.lit(parts)).alias("part")
    )
    pairs = materialize(pairs, "block-pairs")
    blocks = data.withColumnRenamed("block", "d_block")
    left = pairs.select("d_block", "part").distinct().join(blocks, "d_block")
    left = left.select(F.col("d_block").alias("l_block"), F.col("part").alias("l_part"), "dim", "ids", "points")
    right = pairs.join(query.withColumnRenamed("block", "q_block"), "q_block")
    right = right.select(
        F.col("d_block").alias("r_block"), F.col("part").alias("r_part"), "ids", "points", "floors"
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": [], "beyond": [], "order": []}
        if len(left) and len(right):
            dim = int(left["dim"].iloc[0])
            ids = np.frombuffer(left["ids"].iloc[0], dtype=np.int64)
            points = _points(left["points"].iloc[0], len(ids), dim)
            names = [np.frombuffer(b, dtype=np.int64) for b in right["ids"]]
            asked = np.concatenate(names)
            asking = np.concatenate([_points(b, len(n), dim) for b, n in zip(right["points"], names)])
            known = np.concatenate([np.frombuffer(b, dtype=np.float64) for b in right["floors"]])
            best = Best(asked, known, k)
            dual_search(cover_tree(asking), cover_tree(points), asking, points, ids, best)
            for i, heap in enumerate(best.found):
                out["query_id"] += [int(asked[i])] * len(heap)
                out["vec_id"] += [-id_ for _, id_ in heap]
                for score, _ in heap:
                    for name, value in zip(("score", "beyond", "order"), _score_key(int(score))):
                        out[name].append(value)
        kept = {"score": pd.array(out["score"], dtype="Int64"), "order": pd.Series(out["order"], dtype=object)}
        return pd.DataFrame(out | kept)

    found = (
        left.groupBy("l_block", "l_part")
        .cogroup(right.groupBy("r_block", "r_part"))
        .applyInPandas(search, "query_id long, vec_id long, score long, beyond int, order string")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("order"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _pack(
    placed: DataFrame, rows: int, k: int, samples: dict[int, tuple[np.ndarray, np.ndarray]]
) -> DataFrame:
    """One row a block: its ids and points, centre and radius; with ``samples`` also its queries' floors.

    A cell of more than ``rows`` points is dealt by hash into several blocks.
    """
    cells = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    parts = cells.withColumn("parts", F.ceil(F.col("n") / rows)).drop("n")
    # At most PIVOTS cells for each length of vectors.
    dealt = placed.join(F.broadcast(parts), ["dim", "cell"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        ids, points = pdf["vec_id"].to_numpy(), _stack(pdf["v"])
        block = {
            # A number of its own: fewer than 64 cells, and parts in the lower half.
            "block": int(pdf["dim"].iloc[0]) << 38 | int(pdf["cell"].iloc[0]) << 32 | int(pdf["part"].iloc[0]),
            "dim": int(pdf["dim"].iloc[0]),
            **_block(points, ids),
        }
        if samples is not None and int(pdf["dim"].iloc[0]) in samples:
            known_ids, known = samples[int(pdf["dim"].iloc[0])]
            scores = points @ known.T
            # A floor is below the true score whatever the rounding.
            sizes = np.linalg.norm(points, axis=1)[:, None] * np.linalg.norm(known, axis=1)[None, :]
            scores = np.where(sizes * points.shape[1] < EXACT, scores, scores - sizes * points.shape[1] * 2.0**-50)
            scores[np.isnan(scores)] = -np.inf
            scores[ids[:, None] == known_ids[None, :]] = -np.inf
            floors = np.full(len(ids), -np.inf)
            if known.shape[0] > k:
                floors = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
            block["floors"] = floors.tobytes()
            block["floor"] = float(floors.min())
        else:
            block["floors"] = np.full(len(ids), -np.inf).tobytes()
            block["floor"] = -np.inf
        return pd.DataFrame([block])

    packed = dealt.groupBy("dim", "cell", "part").applyInPandas(pack, f"{_BLOCK}, floors binary, floor double")
    return materialize(packed, "blocks")
