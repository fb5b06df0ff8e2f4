"""Token counts by a tokenizer compiled into a deterministic transducer.

White space ends every token of the tokenizers served here, so a text is a run of
words, and a word goes through the transducer byte by byte. A transition says by
how much the number of tokens of what was read so far changes, so counting needs
no token. States are compiled when first met.
"""

from __future__ import annotations

import functools
import gc
import json
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from platewise.llm.common import map_arrow, whole_text

OVER_LIMIT = 2048
# Characters of a text that one task counts; longer texts are cut.
CHUNK_CHARS = 1 << 16
# Most pieces of a text; longer texts get longer pieces.
MOST_CHUNKS = 64
# Words and states that a worker remembers before it starts afresh.
WORD_CACHE, STATE_CACHE, PAIR_CACHE = 400_000, 250_000, 500_000
END = -1

# White space of the tokenizer's normaliser, as character class.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Characters that Python alone takes for white space.
_ONLY_PYTHON = regex.compile(r"[\x1c-\x1f]")
_SPACES = regex.compile(f"[{SPACE}]+")


@functools.cache
def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes for the
    characters from U+0100 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = [], 0
    for byte in range(256):
        if byte in printable:
            letters.append(chr(byte))
        else:
            letters.append(chr(0x100 + extra))
            extra += 1
    return letters


class Memory(dict):
    """Counts by text; one that is met first is worked out. Starts afresh when full."""

    def __init__(self, count: Callable[[str], int]):
        super().__init__()
        self.count = count

    def __missing__(self, text: str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[text] = found = self.count(text)
        return found


class State(dict):
    """Transitions by byte: the next state and the change of the number of tokens.

    ``open`` lists, for every place where a token that is still being read may have
    begun, the node of the vocabulary's trie, the token before that place and the
    number of tokens up to there, relative to now: three numbers a place.
    """

    __slots__ = ("open",)


class Transducer:
    """A word-ending byte-pair encoder as transducer from bytes to token counts.

    The encoding of a string is the one sequence of tokens in which every two
    neighbours encode to themselves. So the last token of what was read is the one
    that ends here and agrees with the last token of what precedes it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix or spec["post_processor"]:
            raise ValueError("a byte-pair tokenizer with word ends is needed")
        # Names of tokens by number; both parts and the rank of the merge that makes each.
        self.names = list(model["vocab"])
        number = {name: i for i, name in enumerate(self.names)}
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = number[left], number[right]
            self.ranks[pair] = rank
            self.made.append(number[left + right])
            self.parts.setdefault(number[left + right], pair)
        special = [t["content"] for t in spec["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        splits = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(p["pattern"]["Regex"] for p in splits if p["type"] == "Split")
        self.pattern = regex.compile(pattern.replace(r"\s", SPACE))
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        # The trie: children of a node by byte, END for the word's end; the token that ends there.
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.spelling: dict[int, list[int]] = {}
        for token, name in enumerate(self.names):
            stem = name.removesuffix(suffix)
            if not stem or any(c not in byte_of for c in stem):
                continue
            letters = [*stem[:-1], stem[-1] + suffix * (stem != name)]
            self.spelling[token] = [number[c] for c in letters]
            node = 0
            for step in [byte_of[c] for c in stem] + [END] * (stem != name):
                if step not in self.children[node]:
                    self.children[node][step] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][step]
            self.token[node] = token
        self.whole: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.agreeing: dict[tuple[int, int], bool] = {}
        self.words = Memory(lambda word: self.count_word(word.encode()))
        self.start_over()

    def start_over(self) -> None:
        self.states: dict[tuple, State] = {}
        if len(self.agreeing) > PAIR_CACHE:
            self.agreeing.clear()
        self.start = self._state((0, -1, 0))

    def merge(self, tokens: list[int]) -> list[int]:
        """Byte-pair encoding of a few tokens, by the order of merges."""
        tokens, none = list(tokens), len(self.ranks)
        while len(tokens) > 1:
            rank, place = min((self.ranks.get(p, none), i) for i, p in enumerate(zip(tokens, tokens[1:])))
            if rank == none:
                break
            tokens[place : place + 2] = [self.made[rank]]
        return tokens

    def stays_whole(self, token: int) -> bool:
        """Whether the token's own letters encode to it."""
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = self.merge(self.spelling[token]) == [token]
        return known

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that come to stand at that end while the token is made, and when each is merged away."""
        if (known := self.edges.get((token, side))) is None:
            known, until, part = [], len(self.ranks), token
            while True:
                known.append((part, until))
                if part not in self.parts:
                    break
                until = self.ranks[self.parts[part]]
                part = self.parts[part][side]
            self.edges[token, side] = known
        return known

    def agree(self, first: int, second: int) -> bool:
        """Whether two tokens stay as they are side by side; ``first`` is -1 at a word's begin.

        They do not if a merge across the border comes before those, inside either,
        that take its two parts away. Of equal merges the left one comes first.
        """
        key = (first, second)
        if (known := self.agreeing.get(key)) is None:
            known = self.stays_whole(second)
            if known and first >= 0:
                ranks, none = self.ranks, len(self.ranks)
                right = self._edge(second, 0)
                for left, until in self._edge(first, 1):
                    for part, limit in right:
                        rank = ranks.get((left, part), none)
                        if rank < until and rank <= limit and rank < none:
                            known = False
            self.agreeing[key] = known
        return known

    def _state(self, open_: tuple) -> State:
        if (state := self.states.get(open_)) is None:
            state = self.states[open_] = State()
            state.open = open_
        return state

    def compile(self, state: State, byte: int) -> tuple[State | None, int]:
        """Add the transition of a state on a byte; END leads to no state."""
        children, tokens, agreeing = self.children, self.token, self.agreeing
        reached, change, ending = [], 0, -1
        open_ = state.open
        for i in range(0, len(open_), 3):
            node = children[open_[i]].get(byte)
            if node is None:
                continue
            last, count = open_[i + 1], open_[i + 2]
            token = tokens[node]
            if token >= 0 and ending < 0:
                known = agreeing.get((last, token))
                if known or known is None and self.agree(last, token):
                    change, ending = count + 1, token
            if children[node]:
                reached += (node, last, count)
        if ending < 0:
            raise ValueError("a byte without a token")
        if byte == END:
            step = state[END] = (None, change)
            return step
        reached[2::3] = [count - change for count in reached[2::3]]
        open_ = (*reached, 0, ending, 0)
        after = self.states.get(open_) or self._state(open_)
        step = state[byte] = (after, change)
        return step

    def count_word(self, data: bytes) -> int:
        """Tokens of one non-empty word of the split pattern."""
        state, total = self.start, 0
        for byte in data:
            step = state.get(byte) or self.compile(state, byte)
            state = step[0]
            total += step[1]
        total += (state.get(END) or self.compile(state, END))[1]
        if len(self.states) > STATE_CACHE:
            self.start_over()
        return total

    def count_run(self, run: str) -> int:
        """Tokens of a run of characters without white space: the library's normaliser and split."""
        if run.isascii() and run.isalpha():
            return self.words[run.lower()]
        total, place = 0, 0
        for match in [*self.specials.finditer(run), None]:
            text = run[place : match.start() if match else len(run)]
            # Lower-casing is by character: no final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            total += sum(map(self.words.__getitem__, self.pattern.findall(text)))
            if match:
                total += 1
                place = match.end()
        return total


class Counts:
    """Token counts of texts: a sum over runs without white space."""

    def __init__(self, path: str):
        self.transducer = Transducer(path)
        self.runs = Memory(self.transducer.count_run)

    def total(self, text: str) -> int:
        runs = _SPACES.split(text) if _ONLY_PYTHON.search(text) else text.split()
        return sum(map(self.runs.__getitem__, runs))


@functools.lru_cache(maxsize=2)
def counts_of(path: str) -> Counts:
    """One compiled tokenizer a worker and file."""
    # What it remembers are millions of small objects that stay: look for garbage rarely.
    gc.set_threshold(100_000, 50, 1000)
    return Counts(path)


def state_map(counts: Counts, text: str) -> tuple[str, int, str, bool]:
    """What a piece of a text does to any state it is entered in.

    White space forgets the state. So a piece with white space turns every state
    into one: what stands before the first space completes the word that was open,
    the middle adds a number, and what stands after the last space is open. A piece
    without white space adds itself to the open word.
    """
    found = _SPACES.search(text)
    if not found:
        return text, 0, "", False
    head, rest = text[: found.start()], text[found.start() :]
    cut = max(m.end() for m in _SPACES.finditer(rest))
    return head, counts.total(rest[:cut]), rest[cut:], True


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = OVER_LIMIT,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row a document: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``tokenizer`` is the path of a tokenizer file with word ends, on every machine.
    Counts are the library's without added tokens; special strings in a text count
    as one token each. A null text is empty and has no token.

    A text of over ``chunk_chars`` characters is cut into pieces, counted in any task.
    A piece is a map of states: the numbers of pieces with white space before it, a
    running sum, say which open word its begin belongs to, so all words that span
    pieces are put together at once, counted, and added. Repeated rows and ids stay
    apart; other columns are not read.
    """

    def short(batch: pa.RecordBatch) -> Iterator[dict]:
        counts = counts_of(tokenizer)
        yield {
            "doc_id": batch.column(0),
            "n_bytes": batch.column(1),
            "n_tokens": [counts.total(text.as_py()) for text in batch.column(2)],
        }

    def pieces(batch: pa.RecordBatch) -> Iterator[dict]:
        counts = counts_of(tokenizer)
        maps = [state_map(counts, text.as_py()) for text in batch.column(4)]
        head, inner, tail, reset = zip(*maps) if maps else ((), (), (), ())
        kept = {name: batch.column(i) for i, name in enumerate(("row", "doc_id", "n_bytes", "chunk"))}
        yield kept | {"head": head, "inner": inner, "tail": tail, "reset": reset}

    def spanning(batch: pa.RecordBatch) -> Iterator[dict]:
        counts = counts_of(tokenizer)
        kept = {name: batch.column(i) for i, name in enumerate(("row", "doc_id", "n_bytes"))}
        words = [counts.total(text.as_py()) for text in batch.column(4)]
        yield kept | {"n_tokens": [a.as_py() + b for a, b in zip(batch.column(3), words)]}

    text = whole_text(text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    # A text of few bytes has few characters.
    whole = rows.filter(F.col("n_bytes") <= chunk_chars).select("doc_id", "n_bytes", "text")
    counted = map_arrow(whole, short, "doc_id long, n_bytes long, n_tokens long")

    width = F.greatest(F.lit(chunk_chars), F.ceil(F.length("text") / MOST_CHUNKS)).cast("int")
    long = rows.filter(F.col("n_bytes") > chunk_chars).withColumns(
        {"row": F.monotonically_increasing_id(), "width": width}
    )
    last = F.expr("cast((length(text) - 1) div width as int)")
    cut = long.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    piece = F.substring("text", F.col("chunk") * F.col("width") + 1, F.col("width"))
    dealt = cut.select("row", "doc_id", "n_bytes", "chunk", piece.alias("text")).repartition("row", "chunk")
    maps = map_arrow(
        dealt,
        pieces,
        "row long, doc_id long, n_bytes long, chunk int, head string, inner long, tail string, "
        "reset boolean",
    )
    before = W.partitionBy("row").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    reset = F.col("reset").cast("long")
    maps = maps.withColumn("word", F.coalesce(F.sum(reset).over(before), F.lit(0)))
    head = F.struct("word", "inner", F.col("head").alias("text"))
    tail = F.struct(
        (F.col("word") + 1).alias("word"),
        F.lit(0).cast("long").alias("inner"),
        F.col("tail").alias("text"),
    )
    ends = F.when(F.col("reset"), F.array(head, tail)).otherwise(F.array(head))
    words = (
        maps.select("row", "doc_id", "n_bytes", "chunk", F.inline(ends))
        .groupBy("row", "doc_id", "n_bytes", "word")
        .agg(
            F.sum("inner").alias("inner"),
            F.array_sort(F.collect_list(F.struct("chunk", "text"))).alias("parts"),
        )
        .select("row", "doc_id", "n_bytes", "inner", F.array_join(F.col("parts.text"), "").alias("text"))
    )
    joined = (
        map_arrow(words, spanning, "row long, doc_id long, n_bytes long, n_tokens long")
        .groupBy("row", "doc_id", "n_bytes")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens")
    )
    return counted.union(joined).withColumn("over_limit", F.col("n_tokens") > limit)
