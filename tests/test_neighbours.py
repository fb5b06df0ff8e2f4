import numpy as np
import pytest

from platewise.operators import neighbours
from platewise.operators.features import FeatureTable
from platewise.operators.neighbours import nearest_profiles, similar_profiles


def table(spark, rows, width):
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, features array<double>")
    return FeatureTable(frame.repartition(3), [f"f{i}" for i in range(width)])


def brute(rows):
    """r of every two rows of an id and some variance."""
    kept = [(i, v) for i, v in rows if i is not None and np.std(v) > 0]
    z = np.array([(v - np.mean(v)) / np.std(v) for _, v in kept])
    r = np.round(z @ z.T / z.shape[1], neighbours.DECIMALS)
    return [(kept[a][0], kept[b][0], r[a, b]) for a in range(len(kept)) for b in range(len(kept)) if a != b]


def clustered(seed, count, width, noise):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    rows = [(i, centres[i % 9] + noise * rng.normal(size=width)) for i in range(count)]
    rows += [(5000 + i, rows[7][1]) for i in range(40)] + [(6000, np.full(width, 3.0)), (None, rows[1][1])]
    return rows


@pytest.mark.parametrize("noise", [0.05, 1.0])
@pytest.mark.parametrize("block_rows", [2048, 25])
def test_against_all_pairs(spark, noise, block_rows):
    rows = clustered(4, 300, 20, noise)
    profiles, pairs = table(spark, rows, 20), brute(rows)
    got = nearest_profiles(profiles, "id", 4, block_rows=block_rows).collect()
    wanted = {}
    for left, right, r in sorted(pairs, key=lambda p: (p[0], -p[2], p[1])):
        if len(wanted.setdefault(left, [])) < 4:
            wanted[left].append(r)
    found = {}
    for row in sorted(got, key=lambda r: (r.left, r.rank)):
        found.setdefault(row.left, []).append(row.r)
    assert found.keys() == wanted.keys()
    assert all(np.allclose(found[i], wanted[i], atol=1e-10) for i in wanted)
    # Among copies the smaller ids come first.
    copies = [r.right for r in sorted(got, key=lambda r: r.rank) if r.left == 5010]
    assert copies == [7, 5000, 5001, 5002]
    near = {(r.left, r.right) for r in similar_profiles(profiles, "id", 0.6, block_rows=block_rows).collect()}
    assert near == {(a, b) for a, b, r in pairs if r >= 0.6}


def test_far_caps_are_not_multiplied(spark, monkeypatch):
    rows = [(i, v) for i, v in clustered(2, 400, 30, 0.02) if i is not None]
    cells = []
    per_cell = neighbours.per_cell
    monkeypatch.setattr(neighbours, "per_cell", lambda copied, *a: cells.append(copied.select(*neighbours.CELL).distinct().count()) or per_cell(copied, *a))
    profiles = table(spark, rows, 30)
    assert similar_profiles(profiles, "id", -1.0).count() == 440 * 439
    everything = cells.pop()
    assert nearest_profiles(profiles, "id", 3).count() == 440 * 3
    assert cells.pop() < everything / 2


def test_few_rows(spark):
    assert nearest_profiles(table(spark, [], 3), "id", 2).count() == 0
    assert nearest_profiles(table(spark, [(1, [1, 2, 3])], 3), "id", 2).count() == 0
    got = nearest_profiles(table(spark, [(1, [1, 2, 3]), (2, [3, 2, 1]), (3, [1, 1, 1])], 3), "id", 2).collect()
    assert [(r.left, r.rank, r.right, r.r) for r in sorted(got)] == [(1, 1, 2, -1.0), (2, 1, 1, -1.0)]
    with pytest.raises(ValueError):
        nearest_profiles(table(spark, [], 3), "id", 0)
