"""URL verdicts: host and path rules, else exact list membership by a Bloom filter cascade."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import lower_ascii, map_arrow
from platewise.session import materialize, small_side

# Largest filter that is sent to every executor; beyond it the list is joined instead.
MAX_FILTER_BYTES = 64 << 20
# Two different keys with equal hashes would never be told apart; then the build stops here.
MAX_LEVELS = 64
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Allow or block a host, all its subdomains and the paths below ``path``."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class Level:
    """One Bloom filter of the cascade."""

    bits: int
    hashes: int
    words: np.ndarray


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bit_places(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bits of each key (a column a key) in the filter of a level; levels hash independently."""
    salt = np.uint64((level + 1) * int(_GOLDEN) % 2**64)
    start, step = _mix(h1.view(np.uint64) + salt), _mix(h2.view(np.uint64) ^ salt) | np.uint64(1)
    turns = np.arange(hashes, dtype=np.uint64)[:, None]
    return (start + turns * step) % np.uint64(bits)


def filter_size(keys: int, others: int) -> tuple[int, int]:
    """Bits and hashes of a filter of ``keys`` that about ``keys / 1.4`` of ``others`` pass."""
    rate = min(0.5, keys / (math.sqrt(2) * max(1, others)))
    hashes = max(1, round(-math.log2(rate)))
    return max(64, math.ceil(keys * hashes / math.log(2) / 64) * 64), hashes


def has_all(level: int, flt: Level, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    places = bit_places(h1, h2, level, flt.hashes, flt.bits)
    found = flt.words[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63)) & np.uint64(1)
    return found.all(axis=0)


def contains(levels: Sequence[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key of the universe is listed.

    The first level that a key fails decides: an even level holds listed keys (and
    those that an odd one took for strangers), an odd level holds strangers that
    the level before let pass.
    """
    listed = np.zeros(len(h1), dtype=bool)
    active = np.arange(len(h1))
    for level, flt in enumerate(levels):
        passes = has_all(level, flt, h1[active], h2[active])
        listed[active[~passes]] = level % 2 == 1
        active = active[passes]
    listed[active] = len(levels) % 2 == 1
    return listed


def _build_level(keys: DataFrame, level: int, bits: int, hashes: int) -> Level:
    """Set the keys' bits on the executors; ``bits / 64`` words at most reach the driver."""

    def words(batch: pa.RecordBatch) -> Iterator[dict]:
        h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        places = np.unique(bit_places(h1, h2, level, hashes, bits))
        masks = (np.uint64(1) << (places & np.uint64(63))).view(np.int64)
        yield {"word": (places >> np.uint64(6)).astype(np.int64), "mask": masks}

    found = map_arrow(keys.select("h1", "h2"), words, "word long, mask long")
    found = found.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[found["word"].to_numpy()] = found["mask"].to_numpy()
    return Level(bits, hashes, out.view(np.uint64))


def _passing(keys: DataFrame, level: int, flt: Level) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        passes = has_all(level, flt, h1, h2)
        yield {"h1": h1[passes], "h2": h2[passes]}

    return map_arrow(keys.select("h1", "h2"), run, "h1 long, h2 long")


def build_cascade(universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> list[Level] | None:
    """Filters that together tell every key of ``universe`` exactly.

    ``universe`` has every key of the corpus once, as ``h1``, ``h2`` (two hashes) and
    ``listed``. The first filter encodes the listed keys, the second the other keys
    that pass the first by mistake, the third the listed keys that pass the second,
    and so on until no key passes by mistake. Returns None where the first filter
    would be over ``max_bytes``; the later ones are smaller.
    """
    universe = materialize(universe.select("h1", "h2", "listed"), "url-keys")
    inside, outside = universe.filter("listed"), universe.filter("not listed")
    sizes = inside.count(), outside.count()
    levels: list[Level] = []
    while sizes[0]:
        bits, hashes = filter_size(*sizes)
        if bits > 8 * max_bytes:
            return None
        number = len(levels)
        if number == MAX_LEVELS:
            raise RuntimeError("two keys have equal hashes")
        levels.append(_build_level(inside, number, bits, hashes))
        wrong = materialize(_passing(outside, number, levels[-1]), "url-passing")
        inside, outside, sizes = wrong, inside, (wrong.count(), sizes[0])
    return levels


def url_host(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From after the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))


def matching_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.host)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.host + rule.path)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """One row a page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    The longest rule that fits decides. Where none does, a page is blocked if its
    host is in the first column of ``listed``, else allowed. All hosts of the pages
    are the universe over which the cascade is exact, so membership needs no join
    and no shuffle of pages. A list whose filter would be over ``max_bytes`` is joined
    on the host instead, which adaptive execution splits at hot hosts.

    Null urls and urls without ``://`` have an empty host and path, which are judged
    like any other. Listed nulls and hosts that no page has change nothing. Repeated
    rows get equal rows; an empty table gives none; other columns are not read.
    """
    url = F.col(f"`{url_col}`")
    judged = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.coalesce(url_host(url), F.lit("")).alias("host"),
        F.coalesce(url_path(url), F.lit("")).alias("path"),
    )
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    judged = judged.withColumns({"rule": rule, "ruled": verdict})
    names = listed.select(F.col(f"`{listed.columns[0]}`").alias("host")).filter("host is not null")
    names = names.distinct()
    hosts = judged.select("host").distinct()
    marked = hosts.join(names.withColumn("listed", F.lit(True)), "host", "left")
    hashes = {"h1": F.xxhash64("host"), "h2": F.xxhash64(F.lit("url"), "host")}
    universe = marked.withColumns(hashes).withColumn("listed", F.coalesce("listed", F.lit(False)))
    levels = build_cascade(universe, max_bytes)
    if levels is None:
        side = small_side(names.withColumn("member", F.lit(True)), names.count())
        judged = judged.join(side, "host", "left")
    else:

        @F.pandas_udf("boolean")
        def member(h1: pd.Series, h2: pd.Series) -> pd.Series:
            return pd.Series(contains(levels, h1.to_numpy(), h2.to_numpy()))

        judged = judged.withColumn("member", member(hashes["h1"], hashes["h2"]))
    otherwise = F.when(F.coalesce("member", F.lit(False)), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", otherwise).alias("verdict")
    )
