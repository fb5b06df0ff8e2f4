import numpy as np
import pyarrow as pa
import pytest

from platewise.columns import COMPOUND
from platewise.operators import pairs as B
from platewise.operators import replicates as R
from platewise.operators.features import InsufficientData, feature_table
from platewise.session import materialize


def table_of(spark, frame):
    return feature_table(spark.createDataFrame(frame.assign(row_id=range(len(frame)))), ["row_id", COMPOUND])


def brute_force(frame):
    x = frame.filter(like="feature_").to_numpy()
    r = np.corrcoef(x)
    scores = {}
    for compound, rows in frame.reset_index(drop=True).groupby(COMPOUND).groups.items():
        if compound != "DMSO" and len(rows) > 1:
            block = r[np.ix_(rows, rows)]
            scores[compound] = np.median(block[np.triu_indices(len(rows), 1)])
    return r, scores


def test_zscores_give_pearson_and_drop_flat_rows(spark, cohort):
    frame = cohort(features=7)
    frame.loc[3, frame.filter(like="feature_").columns] = 1.5
    got = R.row_zscores(table_of(spark, frame), ["row_id"]).orderBy("row_id").collect()
    assert [r.row_id for r in got] == [i for i in range(len(frame)) if i != 3]
    z = np.array([r.zscores for r in got])
    want = np.corrcoef(frame.drop(index=3).filter(like="feature_").to_numpy())
    np.testing.assert_allclose(z @ z.T / 7, want, atol=1e-12)


@pytest.mark.parametrize(
    "block_rows, large, max_values", [(2048, 8192, 1000), (20, 20, 1000), (20, 50, 30), (7, 9, 1), (20, 8192, 30)]
)
def test_scores_by_every_path(spark, cohort, block_rows, large, max_values):
    frame = cohort(plates=6, wells=24, compounds=3, features=12)
    # One compound owns most of the wells, one has a single well.
    frame.loc[30:, COMPOUND] = "cpd01"
    frame.loc[0, COMPOUND] = "alone"
    z = materialize(R.row_zscores(table_of(spark, frame), ["row_id", COMPOUND]))
    scored = R.replicate_scores(
        z, "row_id", block_rows=block_rows, large_block_rows=large, max_values=max_values
    )
    got = {r[COMPOUND]: r.score for r in scored.collect()}
    _, want = brute_force(frame)
    assert set(got) == set(want)
    for compound in want:
        assert got[compound] == pytest.approx(want[compound], abs=1e-12)


def test_reproducibility_separates_signal_from_null(spark, cohort):
    frame = cohort()
    found = R.reproducibility(table_of(spark, frame), "row_id", pairs=400)
    r, scores = brute_force(frame)
    null = [row.r for row in found.null.collect()]
    for value in null[:50]:
        assert np.abs(r - value).min() < 1e-12
    assert found.threshold == pytest.approx(np.percentile(null, 95))
    share = 100 * np.mean(np.array(list(scores.values())) > found.threshold)
    assert found.percent_replicating == pytest.approx(share)
    bins = found.histogram.toPandas()
    edges = np.linspace(min(null + list(scores.values())), max(null + list(scores.values())), 40)
    for name, values in {"null": null, "replicate": list(scores.values())}.items():
        mine = bins[bins.series == name].sort_values("bin")
        counts, _ = np.histogram(values, edges)
        density, _ = np.histogram(values, edges, density=True)
        assert mine["count"].tolist() == counts.tolist()
        np.testing.assert_allclose(mine.density, density)
        np.testing.assert_allclose(mine.left_edge, edges[:-1], atol=1e-12)


@pytest.mark.parametrize("block, most", [(8192, 10**6), (50, 10**6), (30, 40)])
def test_threshold_over_all_pairs(spark, cohort, block, most):
    frame = cohort(plates=4, wells=24, compounds=5, features=9)
    frame.loc[:7, COMPOUND] = None
    z = materialize(R.row_zscores(table_of(spark, frame), ["row_id", COMPOUND]))
    got = R.null_threshold_all(z, "row_id", large_block_rows=block, max_values=most).first().threshold
    r, _ = brute_force(frame)
    labels = frame[COMPOUND].fillna("none").to_numpy()
    upper = np.triu(labels[:, None] != labels[None, :], 1)
    assert got == pytest.approx(np.percentile(r[upper], 95), abs=1e-12)


@pytest.mark.parametrize("plates", [5, 20])
def test_a_larger_cohort_copies_no_row_more_often(spark, cohort, monkeypatch, plates):
    frame = cohort(plates=plates, wells=24, compounds=3, features=6)
    frame.loc[20:, COMPOUND] = "cpd01"
    z = materialize(R.row_zscores(table_of(spark, frame), ["row_id", COMPOUND]))
    copies = []

    def counted(*args):
        cells = B.to_cells(*args)
        copies.append(cells.groupBy("row_id").count().agg(R.F.max("count")).first()[0] or 0)
        return cells

    monkeypatch.setattr(R, "to_cells", counted)
    scored = R.replicate_scores(z, "row_id", block_rows=4, large_block_rows=5, max_values=20)
    got = {r[COMPOUND]: r.score for r in scored.collect()}
    threshold = R.null_threshold_all(z, "row_id", large_block_rows=5, max_values=20).first().threshold
    assert max(copies) == B.COPIES
    r, want = brute_force(frame)
    assert got == pytest.approx(want, abs=1e-12)
    labels = frame[COMPOUND].to_numpy()
    other = np.triu(labels[:, None] != labels[None, :], 1)
    assert threshold == pytest.approx(np.percentile(r[other], 95), abs=1e-12)


def test_blocks_grow_with_their_group_up_to_a_number_of_bytes(spark):
    held = B.BLOCK_BYTES // (8 * 64)
    cases = [(100, 40, 64, 3), (641, 40, 64, 16), (16 * held, 40, 64, 16), (40 * held, 40, 64, 40)]
    # Blocks as asked may be larger than that.
    cases += [(20_000, 8192, 1500, 3), (10 * held, held, 128, 10), (5, 40, 0, 1)]
    for rows, block_rows, width, want in cases:
        blocks = B.growing_block_count(R.F.lit(rows), block_rows, width)
        assert spark.range(1).select(blocks).first()[0] == want


@pytest.mark.parametrize("slab, span", [(512, 8192), (4, 7), (7, 4), (5, 1)])
@pytest.mark.parametrize("label", [None, "label"])
def test_correlations_by_parts_of_a_cell(slab, span, label):
    rng = np.random.default_rng(3)
    z, labels = rng.normal(size=(23, 5)), rng.integers(0, 3, 23)
    for a, b in ((2, 2), (2, 4)):
        block = np.full(23, 2) if a == b else np.where(np.arange(23) % 3 == 0, 2, 4)
        cell = pa.table(
            {
                "row_id": np.arange(23),
                "z": pa.array(z.tolist()),
                "label": labels,
                "__block": block,
                "__cell_a": np.full(23, a),
                "__cell_b": np.full(23, b),
            }
        )
        got = np.concatenate(list(B.correlations(cell, "row_id", "z", slab, label, span)))
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        wanted = left[:, None] < right[None, :] if a == b else np.ones((len(left), len(right)), dtype=bool)
        if label:
            wanted &= labels[left][:, None] != labels[right][None, :]
        want = (z[left] @ z[right].T / 5)[wanted]
        np.testing.assert_allclose(np.sort(got), np.sort(want), atol=1e-12)


def test_null_pairs_draw_evenly_over_a_long_cohort(spark):
    rows = spark.range(200_000).select(
        R.F.col("id").alias("row_id"),
        (R.F.col("id") % 7).cast("string").alias(COMPOUND),
        R.F.array(R.F.col("id").cast("double"), R.F.lit(1.0)).alias(R.ZSCORES),
    )
    null = R.null_pairs(rows, "row_id", pairs=5000)
    left = np.array([r.r for r in null.collect()])
    assert 4100 < len(left) < 4450
    i = spark.range(5000).select(R._draw(R.F.col("id"), R._LEFT, R.F.lit(200_000)).alias("n"))
    drawn = np.array([r.n for r in i.collect()])
    assert drawn.min() >= 0 and drawn.max() < 200_000
    counts = np.histogram(drawn, 10, (0, 200_000))[0]
    assert counts.min() > 400 and counts.max() < 600


def test_guards(spark, cohort):
    frame = cohort(plates=1, wells=6, compounds=6)
    with pytest.raises(InsufficientData, match="replicate"):
        R.reproducibility(table_of(spark, frame), "row_id")
    frame[COMPOUND] = "cpd01"
    with pytest.raises(InsufficientData, match="different"):
        R.reproducibility(table_of(spark, frame), "row_id", pairs=50)
