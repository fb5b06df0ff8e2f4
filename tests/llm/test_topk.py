import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.llm import topk
from platewise.llm.topk import Best, cover_tree, dual_search, top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=10):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.setdefault(i, []).append([int(np.floor(1024 * float(np.float32(x)))) for x in v])
    out = set()
    for q, vectors in whole.items():
        if q % 100:
            continue
        asked = min(vectors, key=lambda v: (len(v), v))
        scored = [
            (-sum(a * b for a, b in zip(asked, v)), i)
            for i, vs in whole.items()
            if i != q
            for v in vs
            if len(v) == len(asked)
        ]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])}
    return out


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return centres[rng.integers(12, size=n)] + rng.normal(scale=0.05, size=(n, dims))


@pytest.mark.parametrize("small_blocks", [False, True])
def test_against_all_pairs(spark, monkeypatch, small_blocks):
    if small_blocks:
        for name, value in {"DATA_ROWS": 40, "QUERY_ROWS": 4, "GROUP_QUERIES": 5, "SAMPLE_ROWS": 60}.items():
            monkeypatch.setattr(topk, name, value)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(1500, 6, 5))]
    # Ties, copies of a query, one id twice, other lengths, and vectors that take no part.
    rows += [(i, rows[100][1]) for i in range(2000, 2030)] + [(300, rows[3][1])]
    rows += [(5000, [1.0, 2.0]), (5100, [0.5, 0.5]), (5001, [3.0, -2.0]), (6000, [])]
    rows += [(None, rows[0][1]), (7000, None), (7100, [float("nan")] + [0.0] * 5), (7200, [None] * 6)]
    rows += [(7300, [float("inf")] + [0.0] * 5)]
    got = top_k(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_few_rows_and_other_queries(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit(1))
    got = top_k(docs, queries=F.col("vec_id") == 3, k=2).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(3, 1, 4), (3, 2, 2)]
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0])], SCHEMA)).count() == 0


def walk(node):
    yield node
    for child in node.children:
        yield from walk(child)


def test_cover_tree_covers_and_separates():
    points = clustered(2000, 8, 6)
    tree = cover_tree(points)
    assert tree.children
    for node in walk(tree):
        away = np.linalg.norm(points[node.rows] - node.centre, axis=1)
        assert away.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
            centres = np.array([c.centre for c in node.children])
            assert (centres[0] == node.centre).all()
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres)) * 1e9
            assert gaps.min() > topk.SHRINK * node.radius


def test_pairs_of_nodes_are_pruned(monkeypatch):
    points = np.floor(1024 * clustered(4000, 8, 7))
    asked = points[::50]
    seen = []
    offer = Best.offer
    monkeypatch.setattr(Best, "offer", lambda self, q, s, i: (seen.append(len(s)), offer(self, q, s, i)))
    best = Best(np.arange(len(asked)) - 10**6, np.full(len(asked), -np.inf), 10)
    dual_search(cover_tree(asked), cover_tree(points), asked, points, np.arange(len(points)), best)
    scores = asked @ points.T
    for q, heap in enumerate(best.found):
        order = np.lexsort((np.arange(len(points)), -scores[q]))[:10]
        assert sorted(heap, reverse=True) == [(int(scores[q, i]), -int(i)) for i in order]
    assert sum(seen) < scores.size / 4


def test_components_of_any_size_are_multiplied_exactly(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(400, 5, 2) * rng.choice([1, 1e4, 1e7], size=(400, 1)))]
    # Two that differ in the last place only, and scores that no long holds, of either sign.
    rows += [(1000, [3e9 + 1, 7.0, 0.0, 0.0, 1.0]), (1001, [3e9 + 1, 7.0, 0.0, 0.0, 2.0]), (1100, [1e9, 0.0, 0.0, 0.0, 1.0])]
    rows += [(1200, [1e25, -3.0, 2.0, 0.0, 0.0]), (1201, [-2e25, 1.0, 0.0, 0.0, 0.0]), (1300, [1e25, -3.0, 2.0, 1.0, 0.0])]
    rows += [(1400, [1e300, 0.0, 0.0, 0.0, 0.0]), (1401, [1e306, 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if i != 1401}
    got = {}
    for r in sorted(top_k(frame).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {i for i in whole if i % 100 == 0}
    for query, found in got.items():
        scored = sorted((-sum(a * b for a, b in zip(whole[query], v)), i) for i, v in whole.items() if i != query)[:10]
        wanted = [(i, -s if -(2**63) <= -s < 2**63 else None) for s, i in scored]
        assert found == wanted, query


def test_keys_of_scores_beyond_a_long_keep_their_order():
    scores = [-(10**90), -(10**40) - 1, -(10**40), -(2**63) - 1, -(2**63), -5, 0, 5, 2**63 - 1, 2**63, 10**40, 10**40 + 1, 10**90]
    keys = [topk._score_key(s) for s in scores]
    assert keys == sorted(keys, key=lambda k: (k[1], k[2] or "", k[0] or 0))
