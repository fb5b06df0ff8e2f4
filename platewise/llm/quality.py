"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from platewise.llm.common import is_held_out, map_arrow, whole_text
from platewise.session import materialize

# Labelled documents that the field is fitted on, and the most lines of all of them together.
TRAINING_DOCS, TRAINING_LINES = 3000, 1_500_000
# Every so many of them sets the scale of the scores instead.
CALIBRATION_PART = 4
ROUNDS, RATE, PENALTY = 200, 0.05, 1e-3
THRESHOLD = 0.3
SEED = 42
# Lines that go through the chain side by side.
BATCH_LINES = 1 << 16

_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL = range(1, 7)
FEATURES = (
    "length", "upper", "digit", "space", "symbol", "stop", "repeated words", "distinct words",
    "word length", "marked words", "ends a sentence", "starts large", "seen before", "empty",
)


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, _SYMBOL, dtype=np.uint8)
    for code in range(0x110000):
        char = chr(code)
        if char.isspace():
            table[code] = _SPACE
        elif char.isupper():
            table[code] = _UPPER
        elif char.isalpha():
            table[code] = _LETTER
        elif char.isdigit():
            table[code] = _DIGIT
    for char in ".,;:'\"-()?":
        table[ord(char)] = _STOP
    return table


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``FEATURES`` a line, and the weight of each line: its characters and one."""
    text = text or ""
    lines = text.split("\n")
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    codes = np.frombuffer(f"{text}\n".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    classes = _classes()[codes]
    starts = np.cumsum(sizes + 1) - sizes - 1
    # The line end that each run includes is a space.
    count = {
        kind: np.add.reduceat(classes == kind, starts, dtype=np.int64)
        for kind in (_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL)
    }
    words = np.zeros((len(lines), 4))
    seen: set[str] = set()
    for i, line in enumerate(lines):
        split = line.split()
        if split:
            repeats = sum(map(operator.eq, split, split[1:]))
            # Words that end in something other than a letter, digit or stop.
            last = sum(not w[-1].isalnum() and w[-1] not in ".,;:'\"-()?" for w in split)
            words[i] = len(split), repeats, len(set(split)), last
            words[i, 1] /= len(split)
            words[i, 2] /= len(split)
            words[i, 3] /= len(split)
            before = len(seen)
            seen.add(line)
            if len(seen) == before and len(split) > 1:
                words[i, 0] = -len(split)
    seen_before = words[:, 0] < 0
    number = np.abs(words[:, 0])
    one = np.maximum(sizes, 1)
    letters = count[_LETTER] + count[_UPPER]
    out = np.empty((len(lines), len(FEATURES)), dtype=np.float32)
    out[:, 0] = np.log1p(sizes)
    out[:, 1] = count[_UPPER] / np.maximum(letters, 1)
    out[:, 2] = count[_DIGIT] / one
    out[:, 3] = (count[_SPACE] - 1) / one
    out[:, 4] = count[_SYMBOL] / one
    out[:, 5] = count[_STOP] / one
    out[:, 6] = words[:, 1]
    out[:, 7] = words[:, 2]
    out[:, 8] = np.log1p(letters / np.maximum(number, 1))
    out[:, 9] = words[:, 3]
    final = classes[np.maximum(starts + sizes - 1, 0)]
    out[:, 10] = (final == _STOP) & (sizes > 0)
    out[:, 11] = (classes[starts] == _UPPER) & (sizes > 0)
    out[:, 12] = seen_before
    out[:, 13] = number == 0
    return out, (sizes + 1).astype(np.float64)


@dataclass(frozen=True)
class Field:
    """Weights of a line's own features, the line's before and the line's after, and of label pairs."""

    mean: np.ndarray
    scale: np.ndarray
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: np.ndarray
    pairs: np.ndarray
    slope: float
    shift: float


def _shift(values: np.ndarray, docs: np.ndarray, by: int) -> np.ndarray:
    """Values of the line before (1) or after (-1), zero beyond the document."""
    out = np.zeros_like(values)
    if by == 1:
        same = docs[1:] == docs[:-1]
        out[1:][same] = values[:-1][same]
    else:
        same = docs[1:] == docs[:-1]
        out[:-1][same] = values[1:][same]
    return out


class Chains:
    """Documents side by side, longest first: row t holds line t of those that have one."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.order = np.argsort(-sizes, kind="stable")
        longest = int(sizes.max()) if len(sizes) else 0
        ordered = sizes[self.order]
        self.live = [int(np.searchsorted(-ordered, -t, side="left")) for t in range(longest)]
        self.first = (np.cumsum(sizes) - sizes)[self.order]

    def odds(self, unary: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log odds of good against bad for every line."""
        forward, backward = np.empty_like(unary), np.zeros_like(unary)
        for t, live in enumerate(self.live):
            at = self.first[:live] + t
            if t == 0:
                forward[at] = unary[at]
            else:
                past = forward[at - 1]
                forward[at] = unary[at] + np.logaddexp(pairs[0, 1], pairs[1, 1] + past)
                forward[at] -= np.logaddexp(pairs[0, 0], pairs[1, 0] + past)
        for t in range(len(self.live) - 2, -1, -1):
            at = self.first[: self.live[t + 1]] + t
            coming = unary[at + 1] + backward[at + 1]
            backward[at] = np.logaddexp(pairs[1, 0], pairs[1, 1] + coming)
            backward[at] -= np.logaddexp(pairs[0, 0], pairs[0, 1] + coming)
        return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_field(features: Sequence[np.ndarray], labels: np.ndarray) -> Field:
    """Fit by the gradient of the likelihood, every line bearing its document's label."""
    parts = np.arange(len(labels)) % CALIBRATION_PART == 0
    if parts.all() or len(set(labels[~parts])) < 2:
        parts[:] = False
    chosen = [f for f, held in zip(features, parts) if not held]
    sizes = np.array([len(f) for f in chosen], dtype=np.int64)
    docs = np.repeat(np.arange(len(chosen)), sizes)
    x = np.concatenate(chosen).astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    wide = np.hstack([x, _shift(x, docs, 1), _shift(x, docs, -1)])
    edges = np.ones((len(x), 3))
    edges[:, 1] = np.append(True, docs[1:] != docs[:-1])
    edges[:, 2] = np.append(docs[1:] != docs[:-1], True)
    wide = np.hstack([wide, edges])
    truth = labels[~parts].astype(np.float64)[docs]
    chains = Chains(sizes)
    inner = np.nonzero(docs[1:] == docs[:-1])[0]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        seen[a, a] = (truth[inner] == a).sum()
    weights, pairs = np.zeros(wide.shape[1]), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, ROUNDS + 1):
        unary = wide @ weights
        forward, backward = chains.odds(unary, pairs)
        error = truth - _sigmoid(forward + backward)
        slope = wide.T @ error / len(x) - PENALTY * weights
        joint = np.empty((len(inner), 2, 2))
        for a in (0, 1):
            for b in (0, 1):
                joint[:, a, b] = a * forward[inner] + pairs[a, b] + b * (unary + backward)[inner + 1]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        np.exp(joint, out=joint)
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        tilt = (seen - joint.sum(axis=0)) / len(x) - PENALTY * pairs
        for gradient, value, m, v in ((slope, weights, *moments[:2]), (tilt, pairs, *moments[2:])):
            m += 0.1 * (gradient - m)
            v += 0.001 * (gradient**2 - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    width = len(FEATURES)
    cut = [weights[i * width : (i + 1) * width] for i in range(3)]
    field = Field(mean, scale, *cut, weights[3 * width :], pairs, 1.0, 0.0)
    held = parts if parts.any() and len(set(labels[parts])) == 2 else ~parts
    measured = [(f, np.ones(len(f))) for f, h in zip(features, held) if h]
    return _calibrated(field, raw_scores(field, measured), labels[held])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _calibrated(field: Field, raw: np.ndarray, labels: np.ndarray) -> Field:
    """Set slope and shift so that scores are frequencies: logistic regression on the raw log odds."""
    x, slope, shift = _logit(raw), 1.0, 0.0
    for _ in range(100):
        p = _sigmoid(slope * x + shift)
        w = p * (1 - p) + 1e-6
        a = np.array([[np.sum(w * x * x) + 1, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        g = np.array([np.sum((labels - p) * x) + 1 - slope, np.sum(labels - p)])
        move = np.linalg.solve(a, g)
        slope, shift = slope + np.clip(move[0], -1, 1), shift + np.clip(move[1], -1, 1)
    values = {k: getattr(field, k) for k in ("mean", "scale", "own", "before", "after", "bias", "pairs")}
    return Field(**values, slope=float(max(slope, 0.05)), shift=float(shift))


def raw_scores(field: Field, docs: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Mean probability of good lines, by weight, of each document."""
    sizes = np.array([len(f) for f, _ in docs], dtype=np.int64)
    owner = np.repeat(np.arange(len(docs)), sizes)
    x = (np.concatenate([f for f, _ in docs]) - field.mean) / field.scale
    unary = x @ field.own + field.bias[0]
    unary += _shift(x @ field.before, owner, 1) + _shift(x @ field.after, owner, -1)
    unary[np.append(True, owner[1:] != owner[:-1])] += field.bias[1]
    unary[np.append(owner[1:] != owner[:-1], True)] += field.bias[2]
    forward, backward = Chains(sizes).odds(unary, field.pairs)
    weight = np.concatenate([w for _, w in docs])
    good = np.bincount(owner, weight * _sigmoid(forward + backward), minlength=len(docs))
    return good / np.bincount(owner, weight, minlength=len(docs))


def score_texts(field: Field, texts: Sequence[str | None]) -> list[float]:
    out: list[float] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    lines = 0
    for i, text in enumerate(texts):
        waiting.append(line_features(text))
        lines += len(waiting[-1][0])
        if lines >= BATCH_LINES or i == len(texts) - 1:
            raw = raw_scores(field, waiting)
            out += _sigmoid(field.slope * _logit(raw) + field.shift).tolist()
            waiting, lines = [], 0
    return out


def learn_field(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> tuple[Field | None, float]:
    """Fit on a bounded sample of labelled documents that are not held out.

    The sample are the ``TRAINING_DOCS`` labelled ids of smallest hash, up to
    ``TRAINING_LINES`` lines in all: of documents with more lines there are fewer, long
    ones as likely as short ones. The driver gets their line features, no text. Ids with
    contradicting labels count as unlabelled. Where these labels are not of two kinds
    there is no field, and the score of every text is the second result: the share of
    good ones among them, with one of either kind added.
    """
    label = F.col(f"`{label_col}`").cast("int")
    usable = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"))
    usable = usable.filter(F.col("label").isin(0, 1) & ~is_held_out("id"))
    agreed = usable.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    agreed = agreed.filter("label = other").drop("other")
    drawn = F.xxhash64(F.lit(SEED), F.col("id"))
    chosen = agreed.orderBy(drawn, "id").limit(TRAINING_DOCS)

    def measure(batch: pa.RecordBatch) -> Iterator[dict]:
        for id_, label, text in zip(*(batch.column(i) for i in range(3))):
            features, _ = line_features(text.as_py())
            row = {"id": [id_.as_py()], "label": [label.as_py()], "lines": [len(features)]}
            # One document of more lines than all may have together is never taken.
            yield row | {"features": [features.tobytes() if len(features) <= TRAINING_LINES else None]}

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")
    measured = map_arrow(rows, measure, "id long, label int, lines long, features binary")
    # Of copies of an id one counts; the order of rows, and with it the fit, must not depend on the tasks.
    single = measured.filter("features IS NOT NULL").groupBy("id").agg(F.min(F.struct("features", "label", "lines")).alias("one"))
    single = materialize(single.select("id", "one.*"), "labelled-lines")
    # At most TRAINING_DOCS rows of small numbers.
    so_far = F.sum("lines").over(W.orderBy(drawn, "id"))
    taken = single.select("id", "lines").withColumn("so_far", so_far).filter(F.col("so_far") <= TRAINING_LINES)
    found = single.join(F.broadcast(taken.select("id")), "id").toPandas().sort_values("id", kind="stable")
    values = found["label"].to_numpy()
    if len(set(values)) < 2:
        return None, (float(values.sum()) + 1) / (len(values) + 2)
    width = len(FEATURES)
    features = [np.frombuffer(f, dtype=np.float32).reshape(-1, width) for f in found["features"]]
    return fit_field(features, values), 0.0


def _scores(field: Field | None, constant: float, texts: list[str | None]) -> list[float]:
    return [constant] * len(texts) if field is None else score_texts(field, texts)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row a document: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Every line of a text gets a probability to be good from a chain of two labels
    whose weights see its own features and those of the lines beside it. Their mean
    by characters, put on the scale of frequencies, is the score. ``predicted`` is 1
    from ``threshold`` on. Null and empty texts are one empty line. Where nothing can
    be learnt, every score is that of ``learn_field``; held-out labels never count.
    Repeated rows get equal results, a long text is judged by all its lines, an empty
    table gives none; other columns are not read.
    """
    field, constant = learn_field(docs, labels, id_col, text_col, label_col)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        scores = _scores(field, constant, [text.as_py() for text in batch.column(2)])
        yield {
            "doc_id": batch.column(0),
            "held_out": batch.column(1),
            "score": scores,
            "predicted": [int(s >= threshold) for s in scores],
        }

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        is_held_out(id_col).alias("held_out"),
        whole_text(text_col),
    )
    return map_arrow(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    Those whose score, as ``score_quality`` gives it, reaches ``THRESHOLD``. It is worked
    out beside each row, so nothing is joined: rows without id and repeated rows are
    judged like any other. Empty texts are an empty line, and an empty table stays empty.
    """
    field, constant = learn_field(docs, labels, id_col, text_col, label_col)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series([s >= THRESHOLD for s in _scores(field, constant, texts.tolist())])

    return docs.filter(good(whole_text(text_col)))
