"""SentencePiece merges with seeded dropout, and decoding without loss."""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import map_arrow, text_blocks, whole_text

DROPOUT = 0.1
SEED = 42
# Different segmentations that a word may have under one seed.
VARIANTS = 16
# Words of more characters are merged one by one with a heap.
LONG_WORD = 48
SPACE = "▁"
# Types of pieces in a model file.
NORMAL, BYTE = 1, 6
# Rank of a pair without merge; 64 times it still fits 32 bits.
_NONE = np.int32(1 << 24)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pieces:
    """A merge-type model: which two symbols merge into which piece, and in what order.

    Symbols are numbers: a piece's id, or for a character without piece the
    negative of its code point less one. Merges are a sorted table of pairs.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("a merge-type model without normalisation is needed")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece spans words")
        self.single = {p: i for p, i in normal.items() if len(p) == 1}
        self.number = -1 - np.arange(0x110000, dtype=np.int32)
        for char, i in self.single.items():
            self.number[ord(" " if char == SPACE else char)] = i
        self.byte_ids = np.array([i for i, p in enumerate(model.pieces) if p.type == BYTE])
        if len(self.byte_ids) != 256:
            raise ValueError("byte pieces are needed to decode without loss")
        # Better scores merge first; equal scores share a rank.
        order = sorted({-model.pieces[i].score for i in normal.values()})
        rank = {score: r for r, score in enumerate(order)}
        found = []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    found.append((left << 20 | right, rank[-model.pieces[i].score], i))
        found.sort()
        table = np.array(found, dtype=np.int64).reshape(-1, 3)
        # Open addressing: a pair's slot is its hash, or the next free one.
        self.mask = (1 << max(4, int(len(table) * 4).bit_length())) - 1
        self.slot_key = np.full(self.mask + 1, -1, dtype=np.int64)
        self.slot_rank = np.full(self.mask + 1, _NONE, dtype=np.int32)
        self.slot_piece = np.zeros(self.mask + 1, dtype=np.int32)
        self.reach = 1
        for (key, at_rank, piece), slot in zip(table.tolist(), self._slots(table[:, 0]).tolist()):
            steps = 1
            while self.slot_key[slot] >= 0:
                slot, steps = (slot + 1) & self.mask, steps + 1
            self.slot_key[slot], self.slot_rank[slot], self.slot_piece[slot] = key, at_rank, piece
            self.reach = max(self.reach, steps)
        # The bytes that each piece stands for.
        raw = [b""] * len(model.pieces)
        for piece, i in normal.items():
            raw[i] = piece.replace(SPACE, " ").encode()
        for byte, i in enumerate(self.byte_ids.tolist()):
            raw[i] = bytes([byte])
        self.raw_size = np.array([len(r) for r in raw], dtype=np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (_mix(keys.view(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair (``_NONE``: there is none) and the piece it makes."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), left.astype(np.int64) << 20 | right)
        slots = self._slots(keys)
        rank = np.full(len(keys), _NONE, dtype=np.int32)
        piece = np.zeros(len(keys), dtype=np.int32)
        open_ = np.arange(len(keys))
        for _ in range(self.reach):
            there = self.slot_key[slots]
            hit = there == keys[open_]
            rank[open_[hit]] = self.slot_rank[slots[hit]]
            piece[open_[hit]] = self.slot_piece[slots[hit]]
            going = ~hit & (there >= 0)
            if not going.any():
                break
            open_, slots = open_[going], (slots[going] + 1) & self.mask
        return rank, piece

    def symbols(self, words: Sequence[str]) -> np.ndarray:
        """Numbers of the characters of all words, one word after another.

        A space is what the model escapes; the escape character itself has no piece.
        """
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return self.number[codes]


@functools.lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """One loaded model a worker and file."""
    return Pieces(path)


def _dropped(
    salt: np.ndarray, begin: np.ndarray, middle: np.ndarray, end: np.ndarray, made: np.ndarray, bound: int
) -> np.ndarray:
    """Whether merging two neighbouring spans of a word into a piece is skipped, by a keyed hash."""
    begin, middle = begin.astype(np.int64), middle.astype(np.int64)
    place = _mix((begin << 42 | middle << 21 | end).astype(np.uint64)) + made.astype(np.uint64)
    return (_mix(_mix(place) ^ salt) >> np.uint64(32)) < np.uint64(bound)


def _merge_long(model: Pieces, symbols: list[int], salt: int, bound: int) -> list[int]:
    """Agenda of one word: a heap of candidate merges, best rank first, then leftmost."""
    size = len(symbols)
    piece, after, before = list(symbols), list(range(1, size + 1)), list(range(-1, size - 1))
    end, heap = list(range(1, size + 1)), []

    def propose(lefts: list[int]) -> None:
        pairs = [(i, after[i]) for i in lefts if i >= 0 and after[i] < size]
        if not pairs:
            return
        i, j = np.array(pairs, dtype=np.int64).T
        rank, made = model.lookup(np.array([piece[k] for k in i]), np.array([piece[k] for k in j]))
        stop = np.array([end[k] for k in j], dtype=np.int64)
        salts = np.full(len(i), salt, dtype=np.uint64)
        take = (rank < _NONE) & ~_dropped(salts, i, j, stop, made, bound)
        for k in np.nonzero(take)[0].tolist():
            heapq.heappush(heap, (int(rank[k]), int(i[k]), int(j[k]), int(stop[k]), int(made[k])))

    propose(list(range(size)))
    alive = [True] * size
    while heap:
        _, i, j, stop, made = heapq.heappop(heap)
        # Stale unless both spans are still as proposed.
        if not alive[i] or not alive[j] or after[i] != j or end[j] != stop:
            continue
        piece[i], after[i], end[i], alive[j] = made, after[j], stop, False
        if after[i] < size:
            before[after[i]] = i
        propose([before[i], i])
    return [piece[i] for i in range(size) if alive[i]]


def segment(
    model: Pieces, words: Sequence[str], variants: np.ndarray, dropout: float, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all words one after another, and how many each word has.

    All short words go through their agendas side by side: a round takes each
    word's best candidate that the keyed hash does not skip and merges it. A skipped
    candidate is skipped in every round, as the hash knows its place only.
    """
    bound = int(dropout * 2**32)
    salts = _mix(_mix(variants.astype(np.uint64) + np.uint64(1)) ^ np.uint64(seed & (2**64 - 1)))
    symbol = model.symbols(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes) - sizes
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    long = np.nonzero(sizes > LONG_WORD)[0]
    for i in long.tolist():
        spelled = symbol[starts[i] : starts[i] + sizes[i]].tolist()
        merged = np.array(_merge_long(model, spelled, int(salts[i]), bound), dtype=np.int32)
        numbers = np.arange(len(merged), dtype=np.int32)
        done.append((np.full(len(merged), i, dtype=np.int32), numbers, merged))
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    begin = (np.arange(len(symbol)) - starts[word]).astype(np.int32)
    if len(long):
        short = sizes[word] <= LONG_WORD
        symbol, word, begin = symbol[short], word[short], begin[short]
    rank = made = None
    while len(symbol):
        same = np.append(word[1:] == word[:-1], False)
        if rank is None:
            rank, made = np.full(len(symbol), _NONE), np.zeros(len(symbol), dtype=np.int32)
            todo = np.nonzero(same)[0]
        else:
            todo = stale[same[stale]]
            rank[stale] = _NONE
        if len(todo):
            r, m = model.lookup(symbol[todo], symbol[todo + 1])
            stop = _ends(begin, word, sizes)[todo + 1]
            r[_dropped(salts[word[todo]], begin[todo], begin[todo + 1], stop, m, bound)] = _NONE
            rank[todo], made[todo] = r, m
        first = np.nonzero(np.append(True, word[1:] != word[:-1]))[0]
        best = np.minimum.reduceat(rank * np.int32(64) + begin, first)
        active = best < _NONE * 64
        # Words without candidate are done.
        count = np.diff(np.append(first, len(word)))
        going = np.repeat(active, count)
        if not active.all():
            rest = ~going
            done.append((word[rest], begin[rest], symbol[rest]))
            if not active.any():
                break
            symbol, word, begin, rank, made = (x[going] for x in (symbol, word, begin, rank, made))
            count, best = count[active], best[active]
        chosen = np.repeat(best & 63, count) == begin
        at = np.nonzero(chosen)[0]
        symbol[at] = made[at]
        keep = np.ones(len(symbol), dtype=bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        symbol, word, begin, rank, made = (x[keep] for x in (symbol, word, begin, rank, made))
        merged = place[at]
        left = merged[(merged > 0)] - 1
        stale = np.concatenate([merged, left[word[left] == word[left + 1]]])
    if not done:
        return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
    word, begin, symbol = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word.astype(np.int64) << 32 | begin)
    word, symbol = word[order], symbol[order]
    return _with_bytes(model, word, symbol, len(words))


def _ends(begin: np.ndarray, word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    follows = np.append(word[1:] == word[:-1], False)
    return np.where(follows, np.append(begin[1:], 0), sizes[word])


def _with_bytes(model: Pieces, word: np.ndarray, symbol: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without piece by the pieces of their bytes."""
    strange = np.nonzero(symbol < 0)[0]
    if len(strange):
        codes, inverse = np.unique(symbol[strange], return_inverse=True)
        spelled = [model.byte_ids[list(chr(-1 - c).encode())] for c in codes.tolist()]
        width = np.ones(len(symbol), dtype=np.int64)
        width[strange] = np.array([len(s) for s in spelled])[inverse]
        start = np.cumsum(width) - width
        word, out = np.repeat(word, width), np.repeat(symbol, width)
        for k, codes_ids in enumerate(spelled):
            places = start[strange[inverse == k]]
            for shift, piece in enumerate(codes_ids):
                out[places + shift] = piece
        symbol = out
    return symbol, np.bincount(word, minlength=words)


# Spaces with what follows them up to a space, or a line end, which no piece holds.
_WORDS = re.compile(r"\n| *[^ \n]+| +")


def encode_block(
    model: Pieces, texts: Sequence[str | None], keys: np.ndarray, dropout: float, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another and their number for each text.

    A word's variant is a hash of the document's key and the word's place in it, so
    the same word is cut differently here and there, and the same everywhere the
    job runs again. Equal words of one variant are segmented once a block.
    """
    split = [_WORDS.findall(f" {t}") if t else [] for t in texts]
    counts = np.array([len(s) for s in split], dtype=np.int64)
    words = [w for s in split for w in s]
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    coded = pa.array(words).dictionary_encode()
    codes, distinct = coded.indices.to_numpy().astype(np.int64), np.array(coded.dictionary.to_pylist(), dtype=object)
    if dropout > 0:
        doc = np.repeat(keys.view(np.uint64), counts)
        place = (np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
        variant = (_mix(doc + place * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(VARIANTS)).astype(np.int64)
    else:
        variant = np.zeros(len(words), dtype=np.int64)
    pairs, inverse = np.unique(codes * VARIANTS + variant, return_inverse=True)
    ids, sizes = segment(model, distinct[pairs // VARIANTS].tolist(), pairs % VARIANTS, dropout, seed)
    starts = np.cumsum(sizes) - sizes
    size = sizes[inverse]
    flat = ids[_ranges(starts[inverse], size)]
    owner = np.repeat(np.arange(len(texts)), counts)
    return flat, np.bincount(owner, size, minlength=len(texts)).astype(np.int64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    shift = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - shift, sizes)


def decode_block(model: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The text of each run of ids: bytes of the pieces, without the space put in front."""
    sizes = model.raw_size[ids]
    raw = model.raw[_ranges(model.raw_start[ids], sizes)].tobytes()
    ends = np.cumsum(sizes)[np.cumsum(counts) - 1] if len(ids) else np.zeros(len(counts), dtype=np.int64)
    out, begin = [], 0
    for count, end in zip(counts.tolist(), ends.tolist()):
        out.append(raw[begin:end].decode("utf-8", "replace").removeprefix(" ") if count else "")
        begin = end if count else begin
    return out


def encode_texts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    dropout: float = DROPOUT,
    seed: int = SEED,
    place_col: str | None = None,
) -> DataFrame:
    """One row a document: ``doc_id``, ``ids`` (piece ids), ``lossless``, ``text_sha256`` of the text.

    ``place_col`` names a whole number that is carried along as ``position``.

    Pieces are those of a merge-type model: the agenda merges the candidate of the
    best score, the leftmost of equals, but a candidate is skipped with probability
    ``dropout``, by a hash of seed, document, word and place. So a run repeats itself
    wherever its tasks go. ``dropout`` 0 gives the library's segmentation, but for
    the escape character U+2581 in a text, which is spelled in bytes here, so that
    decoding gives it back. ``lossless`` says whether decoding the ids, done for every
    row, gives the whole text. Null and empty texts have no ids. Rows without id share
    one key. Repeated rows get equal rows; other columns are not read.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        model = pieces_of(model_path)
        keys = batch.column(2).to_numpy(zero_copy_only=False)
        for begin, texts in text_blocks(batch, 3):
            ids, counts = encode_block(model, texts, keys[begin : begin + len(texts)], dropout, seed)
            offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
            decoded = decode_block(model, ids, counts)
            part = slice(begin, begin + len(texts))
            yield {
                "doc_id": batch.column(0)[part],
                "ids": pa.ListArray.from_arrays(offsets, ids.astype(np.int32)),
                "lossless": [a == b for a, b in zip(decoded, texts)],
                "text_sha256": batch.column(1)[part],
                "position": batch.column(4)[part],
            }

    text = whole_text(text_col)
    key = F.xxhash64(F.col(f"`{id_col}`").cast("long"))
    place = F.col(f"`{place_col}`") if place_col else F.lit(None)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.sha2(text, 256).alias("sha"), key, text,
        place.cast("long").alias("position"),
    )
    schema = "doc_id long, ids array<int>, lossless boolean, text_sha256 string"
    return map_arrow(rows, run, schema + (", position long" if place_col else ""))


def decode_texts(tokens: DataFrame, model_path: str) -> DataFrame:
    """``tokens`` with ``text``, the text that ``ids`` stand for, in place of them; null ids are none."""
    others = [c for c in tokens.columns if c != "ids"]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        model = pieces_of(model_path)
        lists = batch.column(len(others))
        counts = np.array([len(x) if x.is_valid else 0 for x in lists], dtype=np.int64)
        texts = decode_block(model, lists.flatten().to_numpy(zero_copy_only=False), counts)
        yield {c: batch.column(i) for i, c in enumerate(others)} | {"text": texts}

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.select(*others).schema]
    return map_arrow(tokens.select(*others, "ids"), run, ", ".join([*fields, "text string"]))
