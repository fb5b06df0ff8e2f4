import random
import zlib

import numpy as np

from platewise.llm.common import is_held_out
from platewise.llm.langid import (
    DIMENSIONS,
    bundle,
    count_ngrams,
    identify_language,
    letter_vector,
    ngram_vector,
)

WORDS = {
    "aa": "the and that with from this which would there their about other".split(),
    "bb": "der und nicht mit auch über eine werden können zwischen durch".split(),
    "cc": "жизнь город время человек дорога когда потом всегда".split(),
}


def documents(rows=120, seed=11):
    rng = random.Random(seed)
    for i in range(rows):
        lang = rng.choice(sorted(WORDS))
        yield i, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang


def plain_vector(text):
    """Bind and bundle letter by letter."""
    letters = [ord(c.lower()[0]) if c.isalpha() else 0 for c in f" {text} "]
    letters = [c for i, c in enumerate(letters) if c or i == 0 or letters[i - 1]]
    total = np.zeros(DIMENSIONS)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(letter_vector(a), 2) * np.roll(letter_vector(b), 1) * letter_vector(c)
    return total


def test_bundles_are_sums_of_bound_letters(monkeypatch):
    from platewise.llm import langid

    for text in ("The cat,  sat!\n\nÄrger 42 x", "a", "...", "ab", "word " * 500):
        assert np.array_equal(bundle(*count_ngrams(text)), plain_vector(text))
    monkeypatch.setattr(langid, "TEXT_BLOCK", 7)
    assert np.array_equal(bundle(*count_ngrams("The cat,  sat!\n\nÄrger 42 x")), plain_vector("The cat,  sat!\n\nÄrger 42 x"))


def test_vectors_of_other_ngrams_are_nearly_orthogonal():
    vectors = np.stack([ngram_vector(k) for k in range(1, 400, 7)])
    cosines = vectors @ vectors.T / DIMENSIONS - np.eye(len(vectors))
    assert np.abs(cosines).max() < 0.2


def test_held_out_documents(spark):
    rows = [*documents(), (500, None, "aa"), (501, " 12 -", "aa"), (None, "the and that", "aa"), (502, "the and", None)]
    rows += [(3, rows[3][1], rows[3][2]), (504, "жизнь " * 60_000, "zz"), (505, "", "bb")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = identify_language(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert [by_id[i] for i in (500, 501, 505)] == ["und"] * 3
    assert by_id[None] == by_id[502] == "aa" and by_id[504] in ("cc", "zz")
    assert all(by_id[i] == lang for i, _, lang in documents() if i != 3)


def test_labels_of_held_out_documents_are_not_used(spark):
    rows = list(documents())
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    changed = [(i, t, "never" if i in held else lang) for i, t, lang in rows]
    schema = "doc_id long, text string, lang string"
    one, two = (
        sorted(map(tuple, identify_language(spark.createDataFrame(r, schema)).collect())) for r in (rows, changed)
    )
    assert one == two


def test_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    assert identify_language(spark.createDataFrame([], schema)).count() == 0
    only = identify_language(spark.createDataFrame([(1, "some words", None)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in only] == [("und", 0.0)]
    ids = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    got = ids.select("doc_id", is_held_out("doc_id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
