import hashlib
from collections import defaultdict

import numpy as np

from platewise.llm.exactdedup import directory_depths, drop_copies, exact_dedup

SCHEMA = "doc_id long, text string"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[ascii_lower(text)].append(i)
    out = []
    for i, text in rows:
        norm = ascii_lower(text)
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids) if ids else None
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out.append(repr((i, keep, len(groups[norm]), i == keep, digest)))
    return sorted(out)


def rows_of(frame):
    return sorted(
        repr((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in frame.collect()
    )


def cases():
    rng = np.random.default_rng(4)
    rows = [(i, f"Text {rng.integers(300)}") for i in range(900)]
    rows += [(1000 + i, "HOT copy" if i % 2 else "hot COPY") for i in range(700)]
    rows += [(5000, None), (5001, ""), (None, "hot copy"), (None, None), (None, "alone"), (5002, "ÄÖ"), (5003, "äö")]
    rows += [(5004, "x" * 300_000), (5005, "X" * 300_000), (7, rows[7][1]), (1699, "hot copy")]
    return rows


def test_against_grouping(spark):
    docs = spark.createDataFrame(cases(), SCHEMA)
    assert rows_of(exact_dedup(docs)) == brute(cases())
    # Small buckets: the directory doubles, and the large group overflows into pages.
    assert rows_of(exact_dedup(docs, capacity=16)) == brute(cases())


def test_empty_table_and_clashing_columns(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame(
        [(1, "a", "k", 5), (2, "A", "l", 6)], "doc_id long, text string, key string, keep_id int"
    )
    assert [r.keep_id for r in exact_dedup(docs).collect()] == [2, 2]
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(2, "A", "l", 6)]


def test_one_row_a_text_stays(spark):
    kept = drop_copies(spark.createDataFrame(cases(), SCHEMA)).collect()
    texts = [ascii_lower(r.text) for r in kept]
    assert len(texts) == len(set(texts)) == len({ascii_lower(t) for _, t in cases()})


def test_directory_splits_only_overfull_buckets():
    counts = np.zeros(16, dtype=np.int64)
    counts[0], counts[1], counts[8] = 30, 30, 5
    assert directory_depths(counts, 40).tolist() == [4, 4] + [3, 3] + [2] * 4 + [1] * 8
    assert directory_depths(np.zeros(8, dtype=np.int64), 1).tolist() == [0] * 8
