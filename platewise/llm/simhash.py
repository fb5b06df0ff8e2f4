"""SimHash near-duplicates, found with Golay-code fuzzy keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm import golay
from platewise.llm.common import map_arrow
from platewise.llm.components import connected_components
from platewise.session import materialize, small_side

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 3
# First bit and width of the three segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Shingles whose bits are counted at once.
SHINGLE_BLOCK = 1 << 16


def _tokens(text: str | None) -> list[bytes]:
    # bytes.lower and bytes.split know ASCII only: A-Z, and the six ASCII white spaces.
    return (text or "").encode().lower().split()


def _shingle_hashes(tokens: list[bytes], words: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of all shingles, a block at a time; fewer words than a shingle are one."""
    size = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    for begin in range(0, size, SHINGLE_BLOCK):
        end = min(size, begin + SHINGLE_BLOCK)
        runs = [tokens[begin + i : end + i] for i in range(min(words, len(tokens)))]
        yield np.fromiter(
            (digest(s, seed) for s in map(b" ".join, zip(*runs))), dtype="<u8", count=end - begin
        )


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """64-bit SimHash: a bit is set if it is in over half of the shingle hashes."""
    tokens = _tokens(text)
    if not tokens:
        return 0
    counts, size = np.zeros(64, dtype=np.int64), 0
    for hashes in _shingle_hashes(tokens, words, seed):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        size += len(hashes)
    return int(np.packbits(2 * counts > size, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        values = [fingerprint(text.as_py()) for text in batch.column(1)]
        yield {"doc_id": batch.column(0), "fp": values}

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`"))
    return map_arrow(rows, run, "doc_id long, fp long")


def _segments(fps: np.ndarray, places: tuple = SEGMENTS) -> list[np.ndarray]:
    unsigned = fps.view(np.uint64)
    return [
        (unsigned >> np.uint64(low) & np.uint64((1 << width) - 1)).astype(np.int64)
        for low, width in places
    ]


_ORDERED = [(x, y) for x in range(3) for y in range(3) if x != y]


def _exact_and_fuzzy(kind: int, exact: np.ndarray, fuzzy: np.ndarray) -> np.ndarray:
    return (kind << 40) | (exact << 12) | fuzzy


def index_keys(fps: np.ndarray) -> np.ndarray:
    """The keys under which a fingerprint is filed, one row a fingerprint."""
    parts = _segments(fps)
    near = [golay.nearest_key(p) for p in parts]
    keys = [_exact_and_fuzzy(k, parts[x], near[y]) for k, (x, y) in enumerate(_ORDERED)]
    keys.append(_exact_and_fuzzy(len(_ORDERED), near[0], near[1]))
    return np.stack(keys, axis=1)


def search_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys that meet the index key of every fingerprint at three bits or fewer.

    Pigeonhole over three segments: either one segment is equal and another
    differs in one bit at most, or each differs in exactly one. The first case has
    a key of an exact and a fuzzy segment for each ordered pair of segments, the
    second a key of two fuzzy ones.
    """
    parts = _segments(fps)
    probes = [golay.probe_keys(p, width) for p, (_, width) in zip(parts, SEGMENTS)]
    rows, keys = [], []
    for kind, (x, y) in enumerate(_ORDERED):
        row, column = np.nonzero(probes[y] >= 0)
        rows.append(row)
        keys.append(_exact_and_fuzzy(kind, parts[x][row], probes[y][row, column]))
    # Pack each word's keys to the left: at most seven columns remain.
    first, second = (-np.sort(-p, axis=1)[:, :7] for p in probes[:2])
    for i in range(first.shape[1]):
        for j in range(second.shape[1]):
            row = np.nonzero((first[:, i] >= 0) & (second[:, j] >= 0))[0]
            rows.append(row)
            keys.append(_exact_and_fuzzy(len(_ORDERED), first[row, i], second[row, j]))
    return np.concatenate(rows), np.concatenate(keys)


def close_fingerprints(distinct: DataFrame) -> DataFrame:
    """Pairs of nodes whose fingerprints differ in ``MAX_BITS`` bits or fewer.

    ``distinct`` has ``fp`` and ``node``, one row a fingerprint. Keys of all
    fingerprints are joined with the keys under which they are filed; the bits are
    compared inside the join, so only links leave it.
    """

    def filed(batch: pa.RecordBatch) -> Iterator[dict]:
        fps, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        keys = index_keys(fps)
        repeat = np.repeat(np.arange(len(fps)), keys.shape[1])
        yield {"key": keys.ravel(), "fp": fps[repeat], "node": nodes[repeat]}

    def sought(batch: pa.RecordBatch) -> Iterator[dict]:
        fps, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for begin in range(0, len(fps), 4096):
            part = slice(begin, begin + 4096)
            rows, keys = search_keys(fps[part])
            yield {"key": keys, "fp": fps[part][rows], "node": nodes[part][rows]}

    schema = "key long, fp long, node long"
    nodes = distinct.select("fp", "node")
    index = map_arrow(nodes, filed, schema).alias("i")
    probe = map_arrow(nodes, sought, schema).alias("p")
    differing = F.bit_count(F.col("i.fp").bitwiseXOR(F.col("p.fp")))
    close = (
        (F.col("i.key") == F.col("p.key"))
        & (F.col("i.fp") < F.col("p.fp"))
        & (differing <= MAX_BITS)
    )
    return probe.join(index, close).select(
        F.col("i.node").alias("a"), F.col("p.node").alias("b")
    )


def _classes(prints: DataFrame) -> DataFrame:
    """Each fingerprint with ``node``, its smallest id, and ``component_id``."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    distinct = materialize(distinct, "distinct-fingerprints")
    links = close_fingerprints(distinct.filter("node is not null"))
    reached = connected_components(links)
    return distinct.join(reached, "node", "left").select(
        "fp", "node", F.coalesce("component", "node").alias("component_id")
    )


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, ``fingerprint`` (hex) and ``component_id``.

    Fingerprints link at three differing bits or fewer; a component has the
    smallest id that links reach. Equal fingerprints become one node before any
    key is made, so a group of copies costs one node, however large. Null and
    empty texts have fingerprint zero. Repeated rows stay. A row without id takes
    part in no link: a fingerprint that only such rows have gets a null
    component, else they get that of their fingerprint. Other columns are not read. A
    long text is hashed whole, a block of shingles at a time; an empty table gives none.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(_classes(prints), "fp").select("doc_id", hexed, "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: the smallest id of each component.

    Components are those of ``simhash_components``: fingerprints of whole texts,
    however long, that differ in ``MAX_BITS`` bits or fewer, and all that such links
    reach. Texts without words, null included, share one fingerprint and are copies of
    each other. Rows without id stay. Repeated rows of the id that stays do too; exact
    copies are another operator's work. An empty table stays empty.
    """
    components = simhash_components(docs, id_col, text_col)
    gone = components.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    gone = materialize(gone, "near-copies")
    gone = small_side(gone, gone.count())
    return docs.join(gone, docs[id_col].cast("long") == gone["gone"], "left_anti")
