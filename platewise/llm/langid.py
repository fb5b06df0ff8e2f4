"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import functools
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import is_held_out, map_arrow

DIMENSIONS = 1024
NGRAM = 3
SEED = 42
UNKNOWN = "und"
# Letters whose vectors, and n-grams whose vectors, a worker keeps.
LETTER_CACHE, NGRAM_CACHE = 4096, 1 << 14
_LETTER_BITS = 21
_UNICODE = 0x110000
# Code points of a text that become n-grams at once.
TEXT_BLOCK = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, 0 for what is no letter."""
    table = np.zeros(_UNICODE, dtype=np.int64)
    for code in range(_UNICODE):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


@functools.lru_cache(maxsize=LETTER_CACHE)
def letter_vector(code: int) -> np.ndarray:
    """The random vector of +1 and -1 that stands for a letter (0: the gap between words)."""
    words = [
        xxhash.xxh64_intdigest(code.to_bytes(4, "little") + i.to_bytes(4, "little"), SEED)
        for i in range(DIMENSIONS // 64)
    ]
    bits = np.unpackbits(np.array(words, dtype="<u8").view(np.uint8))
    return (2 * bits.astype(np.int8) - 1).astype(np.float32)


_ngrams: OrderedDict[int, np.ndarray] = OrderedDict()


def ngram_vector(key: int) -> np.ndarray:
    """Binding of the n-gram's letters: product of letter vectors, each turned by its place."""
    if (vector := _ngrams.get(key)) is None:
        vector = np.ones(DIMENSIONS, dtype=np.float32)
        for place in range(NGRAM):
            code = key >> _LETTER_BITS * place & (1 << _LETTER_BITS) - 1
            vector = vector * np.roll(letter_vector(code), place)
        if len(_ngrams) >= NGRAM_CACHE:
            _ngrams.popitem(last=False)
        _ngrams[key] = vector
    return vector


def count_ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the text's letters and their counts; runs of other characters are gaps."""
    table, keys, counts = _letters(), [], []
    tail = np.zeros(1, dtype=np.int64)
    for begin in range(0, max(1, len(text)), TEXT_BLOCK):
        block = text[begin : begin + TEXT_BLOCK]
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = np.concatenate([tail, table[codes]])
        if begin + TEXT_BLOCK >= len(text):
            letters = np.append(letters, 0)
        letters = letters[np.append(True, (letters[1:] != 0) | (letters[:-1] != 0))]
        if len(letters) >= NGRAM:
            places = len(letters) - NGRAM + 1
            key = np.zeros(places, dtype=np.int64)
            for place in range(NGRAM):
                key |= letters[NGRAM - 1 - place :][:places] << _LETTER_BITS * place
            distinct, times = np.unique(key, return_counts=True)
            keys.append(distinct)
            counts.append(times)
        tail = letters[-(NGRAM - 1) :]
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if len(keys) == 1:
        return keys[0], counts[0]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def bundle(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of n-gram vectors, each as often as it occurs."""
    total = np.zeros(DIMENSIONS, dtype=np.float64)
    for begin in range(0, len(keys), 4096):
        vectors = np.stack([ngram_vector(k) for k in keys[begin : begin + 4096].tolist()])
        total += counts[begin : begin + 4096].astype(np.float32) @ vectors
    return total


@dataclass(frozen=True)
class Profiles:
    """Unit vectors of the languages, and what all of them share, which is taken away first."""

    languages: list[str]
    shared: np.ndarray
    vectors: np.ndarray


def learn_profiles(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Profiles:
    """Bundle all n-grams of each language, of the documents that are not held out.

    A task adds up counts per language and bundles once, so a language sends one
    vector a task, whatever its share of the rows; Spark sums them. The driver gets
    one vector a language.
    """

    def partial(batch: pa.RecordBatch) -> Iterator[dict]:
        found: dict[str, dict[int, int]] = {}
        for text, lang in zip(batch.column(0), batch.column(1)):
            counter = found.setdefault(lang.as_py(), {})
            for key, times in zip(*(x.tolist() for x in count_ngrams(text.as_py()))):
                counter[key] = counter.get(key, 0) + times
        for lang, counter in found.items():
            total = bundle(
                np.fromiter(counter, dtype=np.int64, count=len(counter)),
                np.fromiter(counter.values(), dtype=np.int64, count=len(counter)),
            )
            yield {
                "lang": [lang] * DIMENSIONS,
                "place": np.arange(DIMENSIONS, dtype=np.int32),
                "total": np.rint(total).astype(np.int64),
            }

    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`")
    rows = docs.filter(~is_held_out(id_col) & text.isNotNull() & lang.isNotNull()).select(text, lang)
    sums = map_arrow(rows, partial, "lang string, place int, total long")
    sums = sums.groupBy("lang", "place").agg(F.sum("total").alias("total")).collect()
    languages = sorted({row["lang"] for row in sums})
    if not languages:
        return Profiles([], np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)))
    vectors = np.zeros((len(languages), DIMENSIONS))
    order = {lang: i for i, lang in enumerate(languages)}
    for row in sums:
        vectors[order[row["lang"]], row["place"]] = row["total"]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    # What the languages have in common tells nothing; with one language there is nothing to compare.
    shared = vectors.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS)
    vectors = vectors - shared
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Profiles(languages, shared, vectors)


def identify(profiles: Profiles, text: str | None) -> tuple[str, float]:
    """The language whose prototype has the largest cosine with the text, and that cosine from 0 to 1."""
    keys, counts = count_ngrams(text or "")
    if not profiles.languages or not (keys != 0).any():
        return UNKNOWN, 0.0
    vector = bundle(keys, counts)
    vector /= max(np.linalg.norm(vector), 1e-12)
    vector -= profiles.shared
    vector /= max(np.linalg.norm(vector), 1e-12)
    cosines = profiles.vectors @ vector
    best = int(np.argmax(cosines))
    return profiles.languages[best], float(np.clip((1 + cosines[best]) / 2, 0, 1))


def identify_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row a document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Prototypes come from the texts and non-null labels of documents that are not
    held out; a document without id is. ``score`` is (1 + cosine) / 2. Null texts
    and texts without a letter are ``und`` with score 0, as is all where nothing
    can be learnt. Equal cosines go to the first language in alphabetical order.
    Repeated rows get equal results; other columns are not read.
    """
    profiles = learn_profiles(docs, id_col, text_col, lang_col)

    def predict(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [identify(profiles, text.as_py()) for text in batch.column(2)]
        yield {
            "doc_id": batch.column(0),
            "held_out": batch.column(1),
            "lang_pred": [lang for lang, _ in found],
            "score": [score for _, score in found],
        }

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        is_held_out(id_col).alias("held_out"),
        F.col(f"`{text_col}`"),
    )
    return map_arrow(rows, predict, "doc_id long, held_out boolean, lang_pred string, score double")
