import itertools
import random
import zlib

import numpy as np

from platewise.llm.quality import (
    FEATURES,
    Chains,
    fit_field,
    keep_good,
    line_features,
    raw_scores,
    score_quality,
    score_texts,
)


def text(rng, good, lines=6):
    words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(9 * lines)]
    out = [" ".join(words[i * 9 : i * 9 + 9]).capitalize() + "." for i in range(lines)]
    if not good:
        out[1:] = [line.upper().replace(" ", "!! | $$ ") for line in out[1:]]
    return "\n".join(out)


def labelled(n=300, seed=12):
    rng = random.Random(seed)
    return [(i, text(rng, i % 4 != 0, rng.randrange(2, 9)), int(i % 4 != 0)) for i in range(n)]


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(13)
    sizes = np.array([3, 1, 6, 4])
    unary, pairs = rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    forward, backward = Chains(sizes).odds(unary, pairs)
    begin = 0
    for size in sizes:
        weight, good = 0.0, np.zeros(size)
        for labels in itertools.product((0, 1), repeat=int(size)):
            score = sum(unary[begin + t] for t in range(size) if labels[t])
            p = np.exp(score + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
            weight += p
            good += p * np.array(labels)
        odds = (forward + backward)[begin : begin + size]
        np.testing.assert_allclose(1 / (1 + np.exp(-odds)), good / weight, rtol=1e-10)
        begin += size


def test_features_of_odd_texts():
    for value in (None, "", "\n", " \n\t", "a", "\n\n\n", "x" * 400_000, "word " * 50_000, "😀 ￿\u0000"):
        features, weights = line_features(value)
        assert features.shape == (max(1, (value or "").count("\n") + 1), len(FEATURES))
        assert np.isfinite(features).all() and (weights > 0).all()
    features, _ = line_features("One two two\nother line\nOne two two")
    assert features[:, FEATURES.index("seen before")].tolist() == [0, 0, 1]
    assert features[0, FEATURES.index("repeated words")] == np.float32(1 / 3)


def test_neighbouring_lines_matter_and_scores_are_whole_text():
    rows = labelled()
    field = fit_field([line_features(t)[0] for _, t, _ in rows], np.array([y for *_, y in rows]))
    rng = random.Random(14)
    good, bad = text(rng, True, 5), text(rng, False, 5)
    odd = "Zeta eta 12 theta"
    inside = [raw_scores(field, [line_features(f"{x}\n{odd}\n{x}")])[0] for x in (good, bad)]
    assert inside[0] > 0.5 > inside[1]
    scores = score_texts(field, [good, bad, f"{good}\n{bad * 30}"])
    assert scores[0] > 0.7 > 0.3 > scores[1] and scores[2] < 0.3


def test_query_and_filter(spark):
    rows = labelled()
    extra = [(None, rows[1][1]), (900, None), (901, ""), (902, "x" * 300_000), (3, rows[3][1])]
    texts = [(i, t) for i, t, _ in rows] + extra
    docs = spark.createDataFrame([(*r, 9) for r in texts], "doc_id long, text string, label int")
    labels = [(i, y) for i, _, y in rows] + [(5, 1), (8, 1), (None, 1), (7, None), (2000, 0)]
    labels = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, text int")
    got = score_quality(docs, labels).collect()
    assert len(got) == len(texts)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all(r.held_out and r.predicted == truth[r.doc_id] for r in held)
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.select("doc_id").collect())) == sorted(
        f"Row(doc_id={r.doc_id})" for r in got if r.predicted
    )


def test_nothing_to_learn_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    held = [i for i in range(60) if i not in learnt]
    assert [r.score for r in score_quality(docs, none).collect()] == [0.5, 0.5]
    texts = docs.union(spark.createDataFrame([(i, "more text") for i in range(3, 60)], docs.schema))
    bad = spark.createDataFrame([(i, 0) for i in learnt if i], "doc_id long, quality int")
    assert {r.predicted for r in score_quality(texts, bad).collect()} == {0}
    assert keep_good(texts, bad).count() == 0
    # Labels of held-out documents say nothing, whatever they are.
    only_held = spark.createDataFrame([(i, 0) for i in held if i], "doc_id long, quality int")
    assert {r.score for r in score_quality(texts, only_held).collect()} == {0.5}
    assert keep_good(texts, only_held).count() == texts.count()
    assert keep_good(docs, none).count() == 2
    assert score_quality(docs.limit(0), none).count() == 0


def test_long_documents_take_part_in_the_fit(spark, monkeypatch):
    from platewise.llm import quality

    rows = [(i, "\n".join(["Good words end here."] * (900 if i % 3 else 2)), 1) for i in range(40)]
    rows += [(100 + i, "\n".join(["### ### 12"] * 700), 0) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    # All bad ones are long.
    assert quality.learn_field(docs, labels)[0] is not None
    seen = []
    monkeypatch.setattr(quality, "fit_field", lambda features, values: seen.append(sum(map(len, features))))
    monkeypatch.setattr(quality, "TRAINING_LINES", 5000)
    quality.learn_field(docs, labels)
    assert 3000 < seen[0] <= 5000
