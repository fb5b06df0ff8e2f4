import random

import public_tokenizers
import pytest
import tokenizers

from platewise.llm.tokencount import Counts, count_tokens, state_map

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcdeſİΣσςéÉ'’ \n\t\x1c\x85\xa0 <|>endoftextstar 0123½Ⅷ五漢字한글กि😀👍🏽́̈​ !?.,-_🇩🇪ﬁ"


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(1500)]
    made += [f"{t}<|endoftext|>{t[::-1]}<|startoftext|>" for t in made[:200]]
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    return [*made, " ".join(words), "a" * 3000, "ab" * 1000 + " x", "", " ", "\n"]


def test_counts_are_the_library_s(texts, library):
    counts = Counts(PATH)
    assert [counts.total(t) for t in texts] == [library(t) for t in texts]


def test_tokens_that_agree_are_those_that_merging_leaves(texts):
    transducer = Counts(PATH).transducer
    rng = random.Random(9)
    tokens = [t for t in transducer.spelling if not transducer.names[t].endswith("</w>")]
    for _ in range(4000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        if transducer.stays_whole(a) and transducer.stays_whole(b):
            merged = transducer.merge(transducer.spelling[a] + transducer.spelling[b])
            assert transducer.agree(a, b) == (merged == [a, b])


def test_forgetting_states_changes_nothing(texts, monkeypatch):
    from platewise.llm import tokencount

    whole = [Counts(PATH).total(t) for t in texts[:300]]
    monkeypatch.setattr(tokencount, "STATE_CACHE", 5)
    monkeypatch.setattr(tokencount, "WORD_CACHE", 3)
    counts = Counts(PATH)
    assert [counts.total(t) for t in texts[:300]] == whole


def test_state_maps_compose(library):
    counts = Counts(PATH)
    text = "  the cat's <|endoftext|>sat on\nunbelievable mats  "
    for cut in range(len(text) + 1):
        first, second = state_map(counts, text[:cut]), state_map(counts, text[cut:])
        total, open_ = 0, ""
        for head, inner, tail, reset in (first, second):
            open_ += head
            if reset:
                total += counts.total(open_) + inner
                open_ = tail
        assert total + counts.total(open_) == library(text)


@pytest.mark.parametrize("chunk", [5, 64, 1 << 16])
def test_query(spark, texts, library, chunk):
    rows = [*enumerate(texts), (None, "no id"), (3, None), (3, None), (4, texts[4])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = count_tokens(docs, PATH, limit=100, chunk_chars=chunk).collect()
    want = [(i, len((t or "").encode()), library(t), library(t) > 100) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert count_tokens(docs.limit(0), PATH).count() == 0
