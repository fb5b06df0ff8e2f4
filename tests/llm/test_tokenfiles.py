import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from platewise.llm import bytepieces, tokenfiles
from platewise.llm.bytepieces import WordEncoder, byte_blocks
from platewise.llm.tokenfiles import IdFile, IdFileReader, IdPlanes, by_document, encode_ids, from_planes, read_token_files, to_planes, write_token_files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"
SIGNS = [" ", "  ", "\n", "\n\n", " \n", "a", "B", "é", "ñ", "×", "÷", "1", "23", ".", ",", "!", "?", ")", "'s", "'", "n't"]
SIGNS += ["<|endoftext|>", " ", "　", " ", "漢字", "。", "\t", "\r\n", "😀", "́", "\x85", "\x1c", "​", "(", "word"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def random_texts(count):
    draw = random.Random(4)
    texts = ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 40))) for _ in range(count)]
    wide = [lambda: draw.randrange(1, 0x250), lambda: draw.randrange(1, 0xD7FF), lambda: 32, lambda: 10]
    return texts + ["".join(chr(draw.choice(wide)()) for _ in range(draw.randint(0, 40))) for _ in range(count)]


def test_words_encoded_once_give_the_ids_of_whole_texts(library, monkeypatch):
    texts = random_texts(1500) + ["", "x" * 30_000, "word " * 20_000, "ab12" * 5_000]
    monkeypatch.setattr(bytepieces, "WORDS", 500)
    encoder = WordEncoder(TOKENIZER)
    for begin, end in byte_blocks(pa.array(texts), 20_000):
        ids, places = encoder.block(pa.array(texts)[begin:end])
        for i in range(begin, end):
            wanted = library.encode(texts[i], add_special_tokens=False).ids
            assert ids[places[i - begin] : places[i - begin + 1]].tolist() == wanted, repr(texts[i])


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("top", [1, 2, 256, 50_257, 2**32])
def test_planes_round_trip(kind, top):
    ids = np.random.default_rng(top).integers(0, top, 1003, dtype=np.uint32)
    planes = to_planes(ids, kind)
    assert (from_planes(planes, len(ids), kind) == ids).all()
    bits = max(0, int(ids.max()).bit_length())
    assert len(planes) == (bits if kind == "bit" else -(-bits // 8))


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_file_round_trip_over_blocks(tmp_path, kind):
    draw = np.random.default_rng(2)
    docs = [(None if i % 7 == 0 else i, draw.integers(0, 50_000, n, dtype=np.uint32)) for i, n in enumerate([0, 1, 70_000, 3, 200_000, 5])]
    path = tmp_path / "x.ids"
    with pa.OSFile(str(path), "wb") as stream:
        out = IdFile(stream, kind, 3)
        for doc_id, ids in docs:
            out.add(doc_id, ids)
        out.close()
    file = IdFileReader(open(path, "rb"), path.stat().st_size)
    assert len(file.blocks) == sum(len(i) for _, i in docs) // tokenfiles.BLOCK_IDS + 1
    found = []
    for table, begins, ends, ids in file.documents(1, len(docs)):
        base = begins[0]
        found += [(r["doc_id"] if r["known"] else None, ids[b - base : e - base]) for r, b, e in zip(table, begins, ends)]
    assert [i for i, _ in found] == [i for i, _ in docs[1:]]
    assert all((a == b).all() for (_, a), (_, b) in zip(found, docs[1:]))
    damaged = bytearray(path.read_bytes())
    damaged[200] ^= 1
    (tmp_path / "y.ids").write_bytes(damaged)
    with pytest.raises(Exception):
        IdFileReader(open(tmp_path / "y.ids", "rb"), len(damaged)).block(0)


def check(spark, library, rows, path, **options):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"ids": F.lit(1), "start": F.lit("x")}).repartition(3)
    write_token_files(docs, path, TOKENIZER, **options)
    got = read_token_files(spark, path).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    at = 0
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, at, len(ids))
        assert row.crc == zlib.crc32(ids.tobytes()) and row.ids == ids.tobytes()
        at += len(ids)
    return got


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_against_the_library(spark, library, tmp_path, monkeypatch, planes):
    rows = list(enumerate(random_texts(150)))
    rows += [(9000, None), (9001, ""), (-5, "first"), (None, "nameless"), (9002, "long words here " * 30_000)]
    path = str(tmp_path / "files")
    got = check(spark, library, rows, path, planes=planes)
    # Only what starts in a range of ids is read.
    some = read_token_files(spark, path, first=got[20].start, last=got[40].start).collect()
    assert sorted(r.start for r in some) == [r.start for r in got[20:40]]
    with pytest.raises(Exception, match="already"):
        write_token_files(spark.createDataFrame(rows[:3], SCHEMA), path, TOKENIZER)
    check_again = spark.createDataFrame(rows[:3], SCHEMA)
    write_token_files(check_again, path, TOKENIZER, overwrite=True)
    assert read_token_files(spark, path).count() == 3
    listed = [p for p in Path(path).iterdir() if p.suffix == ".ids"]
    assert len(listed) <= 3


def test_repeated_rows_share_an_id_and_empty_table(spark, library, tmp_path):
    docs = spark.createDataFrame([(5, "same")] * 200 + [(1, "a"), (9, "z")], SCHEMA)
    write_token_files(docs, str(tmp_path / "hot"), TOKENIZER)
    got = read_token_files(spark, str(tmp_path / "hot")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1] + [5] * 200 + [9]
    assert [r.start for r in got] == list(range(0, 2 * len(got), 2))
    write_token_files(docs.limit(0), str(tmp_path / "none"), TOKENIZER)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_ids_of_a_frame_are_written_as_they_are(spark, tmp_path):
    docs = spark.createDataFrame([(2, "some words"), (1, None), (3, "more, words 12")], SCHEMA)
    write_token_files(docs, str(tmp_path / "texts"), TOKENIZER)
    spark.dataSource.register(IdPlanes)
    encoded = encode_ids(by_document(docs), TOKENIZER)
    encoded.write.format("id_planes").mode("append").save(str(tmp_path / "ids"))
    found = [[tuple(r) for r in read_token_files(spark, str(tmp_path / n)).orderBy("start").collect()] for n in ("texts", "ids")]
    assert found[0] == found[1] and len(found[0]) == 3


def test_a_failed_job_leaves_no_manifest(spark, tmp_path):
    path = str(tmp_path / "failed")
    docs = spark.range(50).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") == 40, F.raise_error(F.lit("broken"))).otherwise("text").alias("text")
    )
    with pytest.raises(Exception, match="broken"):
        write_token_files(docs, path, TOKENIZER)
    assert not (Path(path) / tokenfiles.MANIFEST).exists()
