import hashlib
from collections import Counter
from fractions import Fraction

import pytest

from platewise.llm.mixing import mix_order, mixed

WEIGHTS, OTHER, BLOCK = {"big": 5, "mid": 2, "rare": 1}, 3, 4
SIZES = {"big": 230, "mid": 90, "rare": 7, "x": 20, None: 11, "y": 33}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(f"{s}-{i}", s) for s, n in SIZES.items() for i in range(n)]
    rows = [(n, source, f"text {name}", 7) for n, (name, source) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, slot int").repartition(5)


def brute(rows, weights, other, block, seed="mix"):
    """Slots by a plain simulation of earliest deadline first, round by round."""
    names = [*weights, "*"]
    quota = {**weights, "*": other}
    ids = {n: [] for n in names}
    for doc_id, source in rows:
        ids[source if source in weights else "*"].append(doc_id)
    for n in names:
        ids[n].sort(key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    left = {n: -(-len(ids[n]) // block) for n in names}
    out, slot, done = {}, 0, Counter()
    while any(left.values()):
        q = {n: min(quota[n], left[n]) for n in names}
        size, given, begin = sum(q.values()), Counter(), slot
        for t in range(size):
            waiting = [
                (-(-(given[n] + 1) * size // q[n]), k, n)
                for k, n in enumerate(names)
                if given[n] < q[n] and given[n] * size // q[n] <= t
            ]
            deadline, _, n = min(waiting)
            release = given[n] * size // q[n]
            assert release <= t < deadline
            for place, i in enumerate(ids[n][done[n] * block : (done[n] + 1) * block]):
                out[i] = (done[n], begin + release, begin + deadline, slot, place)
            given[n] += 1
            done[n] += 1
            slot += 1
        for n in names:
            left[n] -= q[n]
    return out


def test_against_simulation(docs):
    got = mix_order(docs, WEIGHTS, OTHER, block_rows=BLOCK).collect()
    want = brute([(r.doc_id, r.source) for r in docs.collect()], WEIGHTS, OTHER, BLOCK)
    assert {r.doc_id: (r.block, r.release, r.deadline, r.slot, r.place) for r in got} == want
    assert len(got) == sum(SIZES.values())


def test_less_than_one_block_from_the_target_while_all_sources_last(spark):
    weights = {"a": 7, "b": 3, "c": 1}
    rows = [(i, "abcd"[i % 4]) for i in range(4000)]
    order = mix_order(spark.createDataFrame(rows, "doc_id long, source string"), weights, 2, block_rows=5)
    slots = {r.slot: r.source for r in order.collect()}
    quota = {**weights, "d": 2}
    given = Counter()
    rounds = min(200 // w for w in quota.values())
    for slot in range(rounds * 13):
        given[slots[slot]] += 1
        for source, weight in quota.items():
            assert abs(given[source] - Fraction(weight, 13) * (slot + 1)) < 1
    assert sorted(slots) == list(range(len(slots)))


def test_mixed_keeps_rows_and_their_order(spark, docs, tmp_path):
    out = mixed(docs, WEIGHTS, OTHER, block_rows=BLOCK)
    assert out.columns == docs.columns
    place = {r.doc_id: (r.slot, r.place) for r in mix_order(docs, WEIGHTS, OTHER, block_rows=BLOCK).collect()}
    rows = out.collect()
    assert [place[r.doc_id] for r in rows] == sorted(place.values())
    assert sorted(map(repr, rows)) == sorted(map(repr, docs.collect()))


def test_rows_without_id_repeated_rows_and_empty_table(spark):
    rows = [(None, "big")] * 9 + [(1, "big")] * 3 + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mix_order(docs, WEIGHTS, OTHER, block_rows=2).collect()
    assert len(got) == len(rows) and len({(r.slot, r.place) for r in got}) == len(rows)
    assert mix_order(docs.limit(0), WEIGHTS, OTHER).count() == 0
    with pytest.raises(ValueError):
        mix_order(docs, {"big": 0}, 1)
