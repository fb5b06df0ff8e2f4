import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from platewise.llm import pieces
from platewise.llm.pieces import Pieces, decode_block, decode_texts, encode_block, encode_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abc the in ▁\n\t  0123é漢字😀́\x00\r"


@pytest.fixture(scope="module")
def model():
    return Pieces(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(10)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(150))) for _ in range(800)]
    return [*made, "", None, " ", "   a", "a" * 4000, "the" * 2000, "The tokenization of words. " * 50]


def encode(model, texts, dropout, seed=1):
    ids, counts = encode_block(model, texts, np.arange(len(texts), dtype=np.int64), dropout, seed)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])], ids, counts


def test_without_dropout_the_library_s_pieces(model, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got, _, _ = encode(model, texts, 0.0)
    for ids, text in zip(got, texts):
        if "▁" not in (text or ""):
            assert ids == library.encode(text or "")


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(model, texts, dropout):
    _, ids, counts = encode(model, texts, dropout)
    assert decode_block(model, ids, counts) == [t or "" for t in texts]


def test_heap_and_rounds_agree(model, texts, monkeypatch):
    rounds, _, _ = encode(model, texts, 0.3)
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    assert encode(model, texts, 0.3)[0] == rounds


def test_seeds_vary_and_repeat(model):
    texts = ["understanding tokenization " * 30] * 3
    first = encode(model, texts, 0.2, seed=1)[0]
    assert encode(model, texts, 0.2, seed=1)[0] == first
    assert encode(model, texts, 0.2, seed=2)[0] != first
    # One word is cut in several ways, here and in other documents.
    assert first[0] != first[1]
    plain = encode(model, texts, 0.0)[0]
    assert sum(map(len, first)) > sum(map(len, plain))
    assert encode(model, ["abc"], 1.0)[0] == [[model.single["▁"], *(model.single[c] for c in "abc")]]


def test_operator(spark, texts):
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 2), (5, texts[5], 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    tokens = encode_texts(docs, PATH, dropout=0.2)
    once, again = tokens.collect(), encode_texts(docs.repartition(7), PATH, dropout=0.2).collect()
    assert sorted(map(repr, once)) == sorted(map(repr, again))
    assert all(r.lossless for r in once)
    decoded = decode_texts(tokens.drop("text_sha256"), PATH).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in decoded) == sorted(
        repr((i, t or "")) for i, t, _ in rows
    )
    assert encode_texts(docs.limit(0), PATH).count() == 0
