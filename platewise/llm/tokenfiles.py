"""Files of token ids: blocks of a fixed size, cut into bit planes, each plane compressed by itself.

A file holds the ids of its documents one after the other, cut into blocks of
``BLOCK_IDS`` ids whatever the documents' ends. A block is turned into planes: plane
``b`` has bit ``b`` of every id (or byte ``b``, for byte planes), so the high planes,
which hardly change, pack to almost nothing. Behind the blocks lie the table of the
documents and the chunk index, one entry a block: where it begins and how long each
of its planes is. A reader seeks the blocks it needs and no others.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from platewise.llm.bytepieces import byte_blocks, word_encoder
from platewise.llm.common import map_arrow

BLOCK_IDS = 1 << 16
# A file ends after so many ids or documents, whichever comes first, with the document.
FILE_IDS, FILE_DOCS = 1 << 26, 1 << 20
# Ids that a reader hands on at once.
BATCH_IDS = 1 << 21
MAGIC = b"IDPLANE1"
MANIFEST = "_manifest.json"
END_ID = 0

_BLOCK = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("planes", "u1"), ("lengths", "<u4", 32)])
_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("end", "<u8")])
_TAIL = np.dtype([("docs", "<u8"), ("index", "<u8"), ("end", "<u8"), ("magic", "S8")])
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
_COLUMNS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block, lowest first, without the empty ones on top."""
    ids = ids.astype("<u4", copy=False)
    bits = int(ids.max(initial=0)).bit_length()
    if kind == "byte":
        parts = ids.view(np.uint8).reshape(-1, 4)
        return [parts[:, b].tobytes() for b in range((bits + 7) // 8)]
    return [np.packbits((ids >> b & 1).astype(np.uint8), bitorder="little").tobytes() for b in range(bits)]


def from_planes(planes: list[bytes], size: int, kind: str) -> np.ndarray:
    ids = np.zeros(size, dtype="<u4")
    for b, plane in enumerate(planes):
        held = np.frombuffer(plane, dtype=np.uint8)
        if kind == "byte":
            ids |= held.astype("<u4") << (8 * b)
        else:
            ids |= np.unpackbits(held, count=size, bitorder="little").astype("<u4") << b
    return ids


class IdFile:
    """Writes one file."""

    def __init__(self, stream, kind: str, level: int):
        self.stream, self.kind = stream, kind
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0
        self.at = stream.write(MAGIC + kind.encode().ljust(4))
        self.blocks: list[tuple] = []
        self.docs: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        self.docs.append((doc_id or 0, doc_id is not None, self.total))
        if self.held >= BLOCK_IDS:
            self._flush(self.held - self.held % BLOCK_IDS)

    def _flush(self, wanted: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, dtype="<u4")
        for begin in range(0, wanted, BLOCK_IDS):
            block = ids[begin : min(wanted, begin + BLOCK_IDS)]
            packed = [self.packer.compress(p) for p in to_planes(block, self.kind)]
            lengths = [len(p) for p in packed]
            self.blocks.append((self.at, len(block), len(packed), lengths + [0] * (32 - len(lengths))))
            self.at += self.stream.write(b"".join(packed))
        self.waiting, self.held = [ids[wanted:].copy()], len(ids) - wanted

    def close(self) -> None:
        self._flush(self.held)
        docs = self.packer.compress(np.array(self.docs, dtype=_DOC).tobytes())
        index = self.packer.compress(np.array(self.blocks, dtype=_BLOCK).tobytes())
        tail = np.array([(self.at, self.at + len(docs), self.at + len(docs) + len(index), MAGIC)], dtype=_TAIL)
        self.stream.write(docs + index + tail.tobytes())
        self.stream.close()


class IdFileReader:
    """Reads one file by its chunk index."""

    def __init__(self, stream, size: int):
        self.stream = stream
        self.unpacker = zstandard.ZstdDecompressor()
        (tail,) = np.frombuffer(self._at(size - _TAIL.itemsize, _TAIL.itemsize), dtype=_TAIL)
        if tail["magic"] != MAGIC:
            raise ValueError("no file of id planes, or an unfinished one")
        docs, index, end = (int(tail[c]) for c in ("docs", "index", "end"))
        self.kind = self._at(len(MAGIC), 4).decode().strip()
        self.docs = np.frombuffer(self.unpacker.decompress(self._at(docs, index - docs)), dtype=_DOC)
        self.blocks = np.frombuffer(self.unpacker.decompress(self._at(index, end - index)), dtype=_BLOCK)

    def _at(self, offset: int, size: int) -> bytes:
        self.stream.seek(offset)
        return self.stream.read(size)

    def block(self, number: int) -> np.ndarray:
        entry = self.blocks[number]
        lengths = entry["lengths"][: entry["planes"]].astype(np.int64)
        held = self._at(int(entry["offset"]), int(lengths.sum()))
        edges = np.concatenate([[0], np.cumsum(lengths)])
        planes = [self.unpacker.decompress(held[a:b]) for a, b in zip(edges[:-1], edges[1:])]
        return from_planes(planes, int(entry["ids"]), self.kind)

    def documents(self, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of the documents numbered ``first`` to ``last``: their rows, starts, ends and ids.

        Only blocks that hold some of their ids are read, each once a run; a run ends
        after about ``BATCH_IDS`` ids, a longer document is a run of its own.
        """
        ends = self.docs["end"].astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        kept, number = None, -1
        while first < last:
            stop = max(first + 1, int(np.searchsorted(ends[:last], starts[first] + BATCH_IDS, side="right")))
            begin, end = int(starts[first]), int(ends[stop - 1])
            parts = []
            for n in range(begin // BLOCK_IDS, (end - 1) // BLOCK_IDS + 1):
                if n != number:
                    kept, number = self.block(n), n
                parts.append(kept[max(0, begin - n * BLOCK_IDS) : end - n * BLOCK_IDS])
            yield self.docs[first:stop], starts[first:stop], ends[first:stop], np.concatenate(parts)
            first = stop


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: name, number of ids and of documents."""

    partition: int
    files: list[tuple[str, int, int]]


@dataclass
class OneFile(InputPartition):
    name: str
    start: int


def _place(path: str) -> tuple[fs.FileSystem, str]:
    found, folder = fs.FileSystem.from_uri(path)
    return found, folder.rstrip("/")


class IdPlanesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.kind, self.level = options.get("planes", "bit"), int(options.get("level", "3"))
        # Spark gives options their names in lower case.
        given = {name.lower(): value for name, value in options.items()}
        self.tokenizer, self.end_id = given.get("tokenizer"), given.get("endid")
        if self.kind not in ("bit", "byte"):
            raise ValueError("planes are of bits or bytes")
        store, folder = _place(self.path)
        if not overwrite and store.get_file_info(f"{folder}/{MANIFEST}").type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} holds token files already")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Every attempt of a task writes files of its own names; the manifest lists those that count."""
        store, folder = _place(self.path)
        store.create_dir(folder, recursive=True)
        partition, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, out = [], None

        def finish() -> None:
            out.close()
            files.append((name, out.total, len(out.docs)))

        for doc_id, ids in self._documents(batches):
            if out is None:
                name = f"part-{partition:06d}-{len(files):04d}-{attempt}.ids"
                out = IdFile(store.open_output_stream(f"{folder}/{name}", compression=None), self.kind, self.level)
            out.add(doc_id, ids)
            if out.total >= FILE_IDS or len(out.docs) >= FILE_DOCS:
                finish()
                out = None
        if out is not None:
            finish()
        return Written(partition, files)

    def _documents(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
        """Ids of each row: those of the column ``ids``, or of the column ``text``, encoded here."""
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            if self.tokenizer is None:
                for doc_id, held in zip(doc_ids, batch.column("ids")):
                    raw = held.as_buffer()
                    yield doc_id, np.frombuffer(raw, dtype="<u4") if raw else np.zeros(0, dtype="<u4")
                continue
            end = np.array([] if self.end_id is None else [int(self.end_id)], dtype="<u4")
            encoder, texts = word_encoder(self.tokenizer), batch.column("text")
            for begin, stop in byte_blocks(texts):
                ids, places = encoder.block(texts[begin:stop])
                for row in range(stop - begin):
                    yield doc_ids[begin + row], np.append(ids[places[row] : places[row + 1]], end)

    def commit(self, messages: list[Written | None]) -> None:
        """Number the files by task and list them with the ids before each; the manifest appears at once."""
        store, folder = _place(self.path)
        store.create_dir(folder, recursive=True)
        files, start = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for name, ids, docs in message.files:
                files.append({"name": name, "start": start, "ids": ids, "docs": docs})
                start += ids
        waiting = f"{folder}/{MANIFEST}.{uuid.uuid4().hex}"
        with store.open_output_stream(waiting, compression=None) as stream:
            stream.write(json.dumps({"planes": self.kind, "block": BLOCK_IDS, "files": files}).encode())
        store.move(waiting, f"{folder}/{MANIFEST}")
        if self.overwrite:
            listed = {f["name"] for f in files}
            for found in store.get_file_info(fs.FileSelector(folder)):
                if found.base_name.endswith(".ids") and found.base_name not in listed:
                    store.delete_file(found.path)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _place(self.path)
        for message in messages:
            for name, _, _ in message.files if message else ():
                store.delete_file(f"{folder}/{name}")


class IdPlanesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        # Only documents whose first id has a number of this range.
        self.first, self.last = int(options.get("first", "0")), int(options.get("last", str(1 << 62)))

    def partitions(self) -> list[OneFile]:
        store, folder = _place(self.path)
        with store.open_input_stream(f"{folder}/{MANIFEST}", compression=None) as stream:
            files = json.loads(stream.read())["files"]
        wanted = [f for f in files if f["start"] < self.last and f["start"] + f["ids"] > self.first]
        return [OneFile(posixpath.join(folder, f["name"]), f["start"]) for f in wanted]

    def read(self, partition: OneFile | None) -> Iterator[pa.RecordBatch]:
        # Without any file there is one partition that names none.
        if partition is None:
            return
        store, _ = _place(self.path)
        with store.open_input_file(partition.name) as stream:
            file = IdFileReader(stream, stream.size())
            starts = np.concatenate([[0], file.docs["end"].astype(np.int64)]) + partition.start
            first, last = (int(np.searchsorted(starts[:-1], edge)) for edge in (self.first, self.last))
            for docs, begins, ends, ids in file.documents(first, last):
                raw = ids.astype("<u4", copy=False).tobytes()
                base = int(begins[0])
                rows = [raw[4 * (b - base) : 4 * (e - base)] for b, e in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(docs["doc_id"], type=pa.int64(), mask=docs["known"] == 0),
                    pa.array(begins + partition.start),
                    pa.array(ends - begins),
                    pa.array(rows, type=pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_COLUMNS)


class IdPlanes(DataSource):
    """``spark.read`` and ``df.write`` of the format ``id_planes``.

    What is written has ``doc_id`` and ``ids``, or ``text`` with the option ``tokenizer``.
    """

    @classmethod
    def name(cls) -> str:
        return "id_planes"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema: StructType) -> IdPlanesReader:
        return IdPlanesReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> IdPlanesWriter:
        return IdPlanesWriter(dict(self.options), overwrite)


def encode_ids(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Columns ``doc_id`` and ``ids``, little-endian unsigned 32-bit numbers, in the order of ``docs``.

    The ids are those of the tokenizers library for the whole text, without special
    tokens of its own; a special string inside a text is the library's own affair. A
    null text counts as empty. Texts pass in blocks of 8 MB of rows; a longer one is a
    block by itself, and its words still reach the library in small parts.
    """
    tail = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        encoder = word_encoder(tokenizer)
        for begin, end in byte_blocks(batch.column(1)):
            ids, places = encoder.block(batch.column(1)[begin:end])
            raw, edges = ids.tobytes(), (4 * places).tolist()
            rows = [raw[a:b] + tail for a, b in zip(edges, edges[1:])]
            yield {"doc_id": batch.column(0)[begin:end], "ids": rows}

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, ids binary")


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and texts in ascending order of the ids, nulls first, over as many tasks as the rows need.

    Rows of one id follow in the order in which they are read. Their place is part of
    the range, so an id that very many rows share is spread over several tasks.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("__place").asc()]
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__place")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = END_ID,
    planes: str = "bit",
    level: int = 3,
    overwrite: bool = False,
) -> str:
    """Encode every whole text and write the ids in ascending order of the documents' ids.

    Files are finished by their tasks under names of their own; only the manifest, which
    is written last, makes them count, so a lost or repeated task leaves no trace. A
    document without text has the end id alone. Repeated rows are documents of their
    own, extra columns are not read, and an empty table gives a manifest of no files.
    """
    docs.sparkSession.dataSource.register(IdPlanes)
    options = {"planes": planes, "level": str(level), "tokenizer": tokenizer}
    if end_id is not None:
        options["endId"] = str(end_id)
    mode = "overwrite" if overwrite else "append"
    # The writer encodes: ids do not travel between two Python workers.
    by_document(docs, id_col, text_col).write.format("id_planes").mode(mode).options(**options).save(path)
    return path


def read_token_files(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Columns ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers, the end id included. With ``first``
    or ``last`` only documents that start in that range of ids are read, by the chunk
    index: other files, and other blocks of these, stay untouched. A damaged plane fails
    its checksum.
    """
    spark.dataSource.register(IdPlanes)
    limits = {k: str(v) for k, v in (("first", first), ("last", last)) if v is not None}
    return spark.read.format("id_planes").options(**limits).load(path)
