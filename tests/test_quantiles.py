import numpy as np
import pandas as pd
import pytest

from platewise.operators import quantiles
from platewise.operators.quantiles import percentile_by_key, percentile_of_large_keys

SAMPLES = {
    "normal": lambda rng: rng.normal(size=3000),
    "ties": lambda rng: rng.integers(0, 3, 3000).astype(float),
    "one value": lambda rng: np.full(3000, 7.25),
    "outlier": lambda rng: np.append(rng.normal(size=2999), 1e300),
    "all scales": lambda rng: rng.choice([-1, 1], 3000) * 10.0 ** rng.uniform(-300, 300, 3000),
    "large offset": lambda rng: 1e15 + rng.integers(0, 5000, 3000),
    "tiny": lambda rng: rng.normal(size=3000) * 1e-200,
    "adjacent doubles": lambda rng: np.where(rng.random(3000) < 0.5, 1000.0, np.nextafter(1000.0, 2000.0)),
    "nearly constant": lambda rng: 1000.0 + rng.integers(0, 5, 3000) * 1.2e-13,
    "denormals": lambda rng: rng.integers(0, 4, 3000) * 5e-324,
    "both infinities": lambda rng: rng.choice([-np.inf, 0.0, 1e308, np.inf], 3000),
    "half infinite": lambda rng: np.append(rng.normal(size=1501), np.full(1499, np.inf)),
}


@pytest.mark.parametrize("p", [0.0, 0.5, 0.99])
def test_narrowing_equals_numpy(spark, p):
    rng = np.random.default_rng(1)
    values = {name: draw(rng) for name, draw in SAMPLES.items()}
    frame = pd.concat(pd.DataFrame({"k": k, "x": v}) for k, v in values.items())
    frame = pd.concat([frame, pd.DataFrame({"k": ["few"] * 4, "x": [1.0, 2.0, 3.0, 10.0]})])
    got = percentile_by_key(spark.createDataFrame(frame), ["k"], "x", p, "q", max_group_rows=20)
    found = {row.k: row.q for row in got.collect()}
    assert set(found) == {*values, "few"}
    for name, sample in values.items():
        ordered = np.sort(sample)
        position = p * (len(sample) - 1)
        low, high = ordered[int(np.floor(position))], ordered[int(np.ceil(position))]
        share = position - np.floor(position)
        want = low if low == high else low * (1 - share) + high * share
        assert found[name] == pytest.approx(want, rel=1e-12, abs=0), name
    assert found["few"] == pytest.approx(np.quantile([1, 2, 3, 10], p))


@pytest.mark.parametrize("limit", [1000, 5])
def test_without_keys_and_with_nulls(spark, limit):
    rows = [(float(i) if i % 2 else None,) for i in range(101)]
    df = spark.createDataFrame(rows, "x double")
    got = percentile_by_key(df, [], "x", 0.5, "q", max_group_rows=limit).collect()
    assert [r.q for r in got] == [50.0]


def test_key_with_only_nulls_beside_a_hot_null_key(spark):
    rows = [(None, float(i)) for i in range(50)] + [("n", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = percentile_by_key(df, ["k"], "x", 0.5, "q", max_group_rows=10).collect()
    assert {r.k: r.q for r in got} == {None: 24.5, "n": None}


@pytest.mark.parametrize("values", [[1000.0, np.nextafter(1000.0, 2000.0), 1000.0], [1.0, 2.0, 500.0, 900.0]])
def test_groups_narrowed_to_single_values(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = percentile_by_key(df, [], "x", 0.5, "q", max_group_rows=1).first()
    assert got.q == np.median(values)


def test_brackets_of_a_sketch_hold_the_rank(spark, monkeypatch):
    """Very many values: two scans, and no narrowing of the rows."""

    def never(*args, **kwargs):
        raise AssertionError("the rows were narrowed")

    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"k": np.repeat(["a", "b", None], 40_000), "x": np.r_[rng.normal(size=80_000), np.full(40_000, 5.0)]})
    frame.loc[::17, "x"] = np.nan
    df = spark.createDataFrame(frame, "k string, x double")
    start = quantiles.start_state
    monkeypatch.setattr(quantiles, "start_state", lambda sizes, p, counted=False: start(sizes, p, counted) if counted else never())
    got = percentile_of_large_keys(df, ["k"], "x", 0.5, "q")
    wanted = frame.groupby("k", dropna=False)["x"].median()
    assert {r.k: r.q for r in got.collect()} == {None if k is None or k != k else k: v for k, v in wanted.items()}


@pytest.mark.parametrize("limit", [50, 10**6])
def test_a_missed_bracket_is_narrowed_over_the_rows(spark, monkeypatch, limit):
    # A bracket without width misses the neighbour of every rank between two values.
    monkeypatch.setattr(quantiles, "MARGIN", 0.0)
    rng = np.random.default_rng(4)
    values = rng.normal(size=(5, 1000))
    rows = [(k, float(x)) for k, some in enumerate(values) for x in some] + [(9, None)]
    got = percentile_of_large_keys(spark.createDataFrame(rows, "k int, x double"), ["k"], "x", 0.5, "q", max_group_rows=limit)
    found = {r.k: r.q for r in got.collect()}
    assert found.pop(9) is None
    assert found == {k: pytest.approx(np.median(some), rel=1e-15) for k, some in enumerate(values)}
