import numpy as np
import pytest
import xxhash

from platewise.llm import golay
from platewise.llm.components import connected_components
from platewise.llm.simhash import (
    drop_near_copies,
    fingerprint,
    index_keys,
    search_keys,
    simhash_components,
)

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    size = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(size)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "One", "one TWO", "a b c", "a b c d a b c d", "Ärger Ä b c d", "x " * 200_000],
)
def test_fingerprint(text):
    assert fingerprint(text) & 2**64 - 1 == plain_fingerprint(text)


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, step=37, dtype=np.int64)
    codewords = words ^ golay._tables()[1][golay.remainders(words)]
    assert not golay.remainders(codewords).any()
    assert np.bitwise_count(words ^ codewords).max() <= 3
    assert len(np.unique(golay._tables()[1])) == 1 << 11


def test_neighbours_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    keys = golay.probe_keys(words, 23)
    assert ((keys >= 0).sum(axis=1) <= 6).all()
    assert (keys == golay.nearest_key(words)[:, None]).any(axis=1).all()
    for bit in range(23):
        assert (keys == golay.nearest_key(words ^ (1 << bit))[:, None]).any(axis=1).all()


def test_every_fingerprint_within_three_bits_is_found():
    rng = np.random.default_rng(2)
    fps = rng.integers(-(2**63), 2**63 - 1, 4000)
    other = fps.copy()
    for _ in range(3):
        other ^= np.int64(1) << rng.integers(0, 64, len(fps))
    filed = index_keys(other)
    rows, keys = search_keys(fps)
    met = np.zeros(len(fps), dtype=bool)
    np.logical_or.at(met, rows, (filed[rows] == keys[:, None]).any(axis=1))
    assert met.all()


def brute(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), group in zip(prints, label):
        if i is not None:
            least[group] = min(least.get(group, i), i)
    return sorted((repr(i), f"{f:016x}", least.get(g)) for (i, f), g in zip(prints, label))


def test_components_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(12):
        base = list(rng.choice(words, 300))
        for j in range(6):
            text = base.copy()
            for _ in range(j // 2):
                text[rng.integers(300)] = "other"
            rows.append((i * 10 + j, " ".join(text)))
    rows += [(900, None), (901, ""), (902, " "), (3, rows[3][1]), (3, rows[3][1]), (903, "Same"), (904, "same")]
    got = simhash_components(spark.createDataFrame(rows, SCHEMA))
    assert sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in got.collect()) == brute(rows)


def test_rows_without_id_and_empty_table(spark):
    rows = [(None, "lonely words here now"), (7, "Same text"), (None, "same text")]
    got = {(r.doc_id, r.component_id) for r in simhash_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(None, None), (7, 7), (None, 7)}
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_copies_go_with_all_columns_kept(spark):
    rows = [(1, "a b c", "x"), (2, "A B C", "y"), (3, "other text", "z"), (None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [rows[0], rows[2], rows[3]]))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(i, 0) for i in range(1, 61)} | {
        (i, 1000) for i in range(1001, 1100)
    }


def test_one_document_of_each_component_stays(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(8):
        base = [f"w{x}" for x in rng.integers(0, 300, 200)]
        for j in range(20):
            text = base.copy()
            for at in rng.integers(0, len(base), j // 8):
                text[at] = f"new{rng.integers(9)}"
            rows.append((i * 100 + j, " ".join(text)))
    rows += [(5000, "x " * 300_000), (5001, "X " * 300_000), (5002, None), (5003, ""), (rows[0])]
    kept = [r.doc_id for r in drop_near_copies(spark.createDataFrame(rows, SCHEMA)).collect()]
    wanted = [i for (i, _), (_, _, least) in zip(sorted(rows, key=lambda r: repr(r[0])), brute(rows)) if i == least]
    assert sorted(kept) == sorted(wanted)
    assert len(set(kept)) < 60
    assert drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
