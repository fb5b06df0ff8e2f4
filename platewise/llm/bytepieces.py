"""Byte-level token ids of whole texts, by the tokenizers library, with words encoded once."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words remembered by a Python worker, and bytes of text looked at or given to the library at once.
WORDS, BLOCK_BYTES, LIBRARY_BYTES = 600_000, 4 << 20, 1 << 18


def _classes() -> np.ndarray:
    """What a byte is: 1 a letter, 2 a digit, 3 a mark, 4 a line end, 5 a space, 6 another printing sign."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[0x21:0x7F] = 6
    for sign in b".,;:!?)":
        kind[sign] = 3
    kind[list(range(0x41, 0x5B)) + list(range(0x61, 0x7B))] = 1
    kind[0x30:0x3A] = 2
    kind[0x0A], kind[0x20] = 4, 5
    return kind


_KIND = _classes()
# Lead bytes of characters none of which is white space in any version of Unicode.
_JOINED = re.compile(rb" (?:[A-Za-z]|[\xc3-\xc8][\x80-\xbf]).*(?:[A-Za-z0-9]|[\xc3-\xc8][\x80-\xbf])", re.DOTALL).fullmatch
_PLAIN_LEAD = np.zeros(256, dtype=bool)
_PLAIN_LEAD[[*range(0xC3, 0xE1), *range(0xE4, 0xEF), *range(0xF0, 0xF5)]] = True


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places where text of UTF-8 bytes can be cut without a change of its ids.

    The tokenizer's pattern never joins a sign that is no white space with a space
    or a line end after it, letters with digits, or letters and digits with the
    marks after them, and a line end between two such signs stands alone. Only
    characters that every version of Unicode classes alike count; a special token
    has no such place inside.
    """
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    kind = _KIND[data]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = (kind[1:] % 4 > 0) & (kind[1:] != 5) | _PLAIN_LEAD[data[1:]]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = (kind[:-1] % 4 > 0) & (kind[:-1] != 5)
    # A character of two bytes ends before this one.
    two = np.zeros(len(data), dtype=bool)
    two[2:] = (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    before |= two
    lone = before & after
    cut = lone & ((kind == 5) | (kind == 4))
    cut[1:] |= lone[:-1] & (kind[:-1] == 4)
    # Letters of two bytes: U+00C0 to U+024F but for the two signs of arithmetic among them.
    long_letter = np.zeros(len(data), dtype=bool)
    long_letter[2:] = (data[:-2] >= 0xC3) & (data[:-2] <= 0xC8)
    long_letter[2:] &= ~((data[:-2] == 0xC3) & ((data[1:-1] == 0x97) | (data[1:-1] == 0xB7)))
    letter, digit = kind == 1, kind == 2
    word_before = long_letter.copy()
    word_before[1:] |= letter[:-1] | digit[:-1]
    cut |= word_before & (kind == 3)
    cut[1:] |= (letter[:-1] & digit[1:]) | (digit[:-1] & letter[1:])
    return np.flatnonzero(cut)


class WordEncoder:
    """Ids of texts as the library gives them; a word that was seen is not encoded again."""

    def __init__(self, path: str):
        # A task has one core; the library's own threads would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        # A byte is one character of a token's spelling; special tokens are spelled as they are.
        self.bytes_of = np.zeros(self.library.get_vocab_size(), dtype=np.int64)
        for token, i in self.library.get_vocab().items():
            self.bytes_of[i] = len(token.encode()) if token in special else len(token)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Encode words as one text and cut its ids where the words end.

        Only words that begin with a space and a letter and end in a letter or digit
        are joined, so that the text can be cut before each.
        """
        joined, alone = [], []
        for word in words:
            (joined if _JOINED(word) else alone).append(word)
        begin = 0
        while begin < len(joined):
            end, size = begin, 0
            while end < len(joined) and size < LIBRARY_BYTES:
                size += len(joined[end])
                end += 1
            part = joined[begin:end]
            ids = np.array(self._ids(b"".join(part)), dtype="<u4")
            stops = np.cumsum([len(w) for w in part])
            cuts = np.searchsorted(np.cumsum(self.bytes_of[ids]), stops) + 1
            raw, last = ids.tobytes(), 0
            for word, cut in zip(part, cuts.tolist()):
                self.known[word] = raw[4 * last : 4 * cut]
                last = cut
            begin = end
        for begin in range(0, len(alone), 1024):
            part = alone[begin : begin + 1024]
            found = self.library.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for word, ids in zip(part, found):
                self.known[word] = np.array(ids.ids, dtype="<u4").tobytes()

    def _ids(self, text: bytes) -> list[int]:
        (found,) = self.library.encode_batch_fast([text.decode()], add_special_tokens=False)
        return found.ids

    def block(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids begin, one place more than texts."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        edges = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, dtype=np.uint8)[edges[0] : edges[-1]] if held else np.zeros(0, dtype=np.uint8)
        edges = edges - edges[0]
        marked = np.zeros(len(data) + 1, dtype=bool)
        marked[edges] = marked[safe_cuts(data)] = True
        cuts = np.flatnonzero(marked)
        offsets = pa.array(cuts, type=pa.int64()).buffers()[1]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(data)])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > WORDS:
            self.known.clear()
        missing = [w for w in distinct if w not in self.known]
        if missing:
            self._learn(missing)
        pieces = [self.known[w] for w in distinct]
        sizes = np.array([len(p) for p in pieces], dtype=np.int64) // 4
        flat = pa.array(np.frombuffer(b"".join(pieces), dtype="<u4"))
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), flat)
        ids = lists.take(coded.indices).flatten().to_numpy()
        ends = np.cumsum(sizes[coded.indices.to_numpy()])
        places = np.concatenate([[0], ends])
        return ids, places[np.searchsorted(cuts, edges)]


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)


def byte_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes: first row and the row after the last."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    begin, done = 0, 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(sizes, done + limit)))
        yield begin, end
        begin, done = end, int(sizes[min(end, len(texts)) - 1])
