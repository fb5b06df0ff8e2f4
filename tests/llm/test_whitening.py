import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.llm.whitening import fit_whitening, leading_eigenvectors, whiten, whole_numbers

SCHEMA = "vec_id long, embedding array<float>"


def spectrum(values, seed=0):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return turn * values @ turn.T


@pytest.mark.parametrize(
    "values",
    [
        np.exp(-np.arange(400) / 20.0),
        1 / (1 + np.arange(600.0)),
        np.r_[np.linspace(70, 65, 16), np.linspace(64.9, 58, 80)],
        np.ones(90),
        np.r_[np.full(17, 5.0), np.ones(150)],
        np.r_[np.ones(3), np.zeros(60)],
        np.array([2.0, 1.0, 0.5]),
    ],
)
def test_eigenvectors_by_products_alone(values):
    matrix = spectrum(values)
    found, vectors = leading_eigenvectors(lambda q: matrix @ q, len(values), min(16, len(values)))
    assert np.allclose(found, np.sort(values)[::-1][:16], rtol=0, atol=1e-12 * values.max())
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * values.max()
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)


def brute(rows, components=16):
    whole = [(i, np.floor(64 * np.float32(v).astype(float)).astype(np.int64) + 1_000_000)
             for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    fit = np.unique([x for _, x in whole], axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    z = [(n * x - sums) / n @ vectors / np.sqrt(values) for _, x in whole]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)) for _, x in whole]
    return [i for i, _ in whole], n, np.array(z), deviations, values / np.trace(covariance)


def test_against_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(700, 40)) * np.linspace(3, 0.5, 40)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    # Copies count once in the fit; rows that hold no whole vector take no part.
    rows += [(1000 + i, rows[5][1]) for i in range(300)] + [rows[7], rows[7]]
    bad = [(2000, None), (2001, [None] * 40), (2002, [float("nan")] * 40), (2003, [float("inf")] + [0.0] * 39), (2004, [])]
    frame = spark.createDataFrame(rows + bad, SCHEMA).withColumns({"x": F.lit("a"), "n": F.lit(1), "component": F.lit(2)})
    got = whiten(frame.repartition(5)).orderBy("vec_id", "component").toPandas()
    ids, n, z, deviations, explained = brute(rows)
    assert len(got) == 16 * len(ids) and (got.n == n).all()
    wide = got.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    found = wide.loc[ids].to_numpy()
    assert np.abs(found * np.sign((found * z).sum(axis=0)) - z).max() < 1e-9
    first = got[got.component == 1].drop_duplicates("vec_id").set_index("vec_id")
    assert first.deviation.loc[ids].tolist() == deviations
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10


def test_few_dimensions_low_rank_and_nothing_to_whiten(spark):
    def of(rows):
        return whiten(spark.createDataFrame(rows, SCHEMA))

    rng = np.random.default_rng(1)
    line = [(i, [float(t), 2.0 * t, 0.0]) for i, t in enumerate(rng.integers(-50, 50, 60).tolist())]
    out = of(line)
    assert {r.component for r in out.collect()} == {1}
    assert out.filter("abs(explained - 1) > 1e-9 OR identity_error > 1e-9").count() == 0
    assert of([]).count() == 0 and of([(1, None), (2, [])]).count() == 0
    # One distinct vector has no variance.
    assert of([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0
    # A null id is whitened like any other.
    assert of([(None, [1.0, 2.0]), (2, [3.0, 2.0])]).filter("vec_id IS NULL").count() == 1
    with pytest.raises(ValueError):
        of([(1, [1.0]), (2, [1.0, 2.0]), (3, [2.0])])


def test_large_entries(spark):
    rows = [(i, [2.0**40 * i, float(i % 3)]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    fit = fit_whitening(whole_numbers(frame))
    assert fit.n == 40 and fit.sums[0] == sum(64 * 2**40 * i + 1_000_000 for i in range(40))
    out = whiten(frame)
    # A deviation that no long holds is null; the second component is below rounding.
    assert out.filter("deviation IS NOT NULL").count() == 0 and out.count() == 40
    with pytest.raises(Exception, match="64 bits"):
        whiten(spark.createDataFrame([(1, [1e30]), (2, [0.0])], "vec_id long, embedding array<double>"))
