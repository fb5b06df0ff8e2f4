"""One query per operator of this package over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm.chat import link_tool_calls
from platewise.llm.exactdedup import exact_dedup
from platewise.llm.langid import identify_language
from platewise.llm.mixing import mix_order
from platewise.llm.pieces import encode_texts
from platewise.llm.quality import score_quality
from platewise.llm.repair import conversation_digests, repair_conversations
from platewise.llm.simhash import simhash_components
from platewise.llm.tokencount import count_tokens
from platewise.llm.tokenfiles import read_token_files, write_token_files
from platewise.llm.topk import top_k
from platewise.llm.urlfilter import Rule, judge_urls, url_host
from platewise.llm.whitening import whiten
from platewise.operators.joins import join_null_safe
from platewise.session import scratch_path

# Target shares of the sources in hundredths; the rest of the sources share OTHER.
TARGETS = {"src0": 25, "src1": 15, "src2": 10, "src3": 5, "src4": 5}
OTHER = 40

URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
# Words in a host's name that put it on the list.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")

# Schemas of the tools that the user turns are read as calls of.
TOOLS = {
    "outline": {
        "depth": {"type": "integer", "required": True, "minimum": 1, "maximum": 5},
        "text": {"type": "string", "required": True},
    },
    "search": {
        "limit": {"type": "integer", "required": True, "minimum": 1, "maximum": 40},
        "query": {"type": "string", "required": True, "max_length": 300},
    },
}

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_language(spark: SparkSession, sf: str) -> DataFrame:
    return identify_language(_table(spark, sf, "documents"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_components(_table(spark, sf, "documents"))


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mix_order(_table(spark, sf, "documents"), TARGETS, OTHER)


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The list: every host of the pages with a listed word in its name."""
    pages = _table(spark, sf, "pages")
    hosts = pages.select(url_host(F.col("url")).alias("host")).distinct()
    listed = hosts.filter(F.col("host").rlike(rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"))
    return judge_urls(pages, URL_RULES, listed)


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op6_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Varied segmentations of every text, and whether they decode to it."""
    tokens = encode_texts(_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    count, digest = F.size("ids").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash")
    return tokens.select("doc_id", count, digest, "text_sha256", "lossless")


def op7_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(_table(spark, sf, "embeddings"))


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(_table(spark, sf, "documents"))


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_chat(spark: SparkSession, sf: str) -> DataFrame:
    """User turns as calls, the assistant's next turn as the result, all other turns as messages."""
    turns = _table(spark, sf, "conversations")
    size = F.length("text")
    outline = F.coalesce(F.contains("text", F.lit("\n")), F.lit(False))
    # Some depths are text and some limits out of range, so validation has work to do.
    depth = F.to_json(F.struct((size % 6).alias("depth"), "text"))
    wrong_depth = F.to_json(F.struct((size % 6).cast("string").alias("depth"), "text"))
    limit = F.to_json(F.struct(F.col("text").alias("query"), (size % 50).alias("limit")))
    call = F.concat(F.lit("call_"), F.col("turn").cast("string"))
    calls = turns.filter(F.col("role") == "user").select(
        "conv_id",
        call.alias("call_id"),
        "turn",
        F.when(outline, "outline").otherwise("search").alias("tool"),
        F.when(outline & (size % 7 == 0), wrong_depth).when(outline, depth).otherwise(limit).alias("arguments"),
        F.when(F.col("turn") >= 2, F.concat(F.lit("call_"), (F.col("turn") - 2).cast("string"))).alias("after"),
    )
    results = turns.filter(F.col("role") == "assistant").select(
        "conv_id",
        F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    role = F.coalesce(F.col("role"), F.lit(""))
    messages = turns.filter(~role.isin("user", "assistant")).select("conv_id", "turn", "role", F.col("text").alias("content"))
    return link_tool_calls(calls, results, TOOLS, messages)


def op11_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """The files are written to a new folder beside the session's other intermediate tables."""
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    crc = F.crc32("ids").alias("ids_crc32")
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", crc)


def _damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by the checksum of their conversation and number."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    without_ends = F.translate(text, ".!?", "")
    hurt = turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, without_ends).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return hurt.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def op12_repair(spark: SparkSession, sf: str) -> DataFrame:
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    repair = repair_conversations(_damaged(turns))
    found = join_null_safe(turns.select("conv_id").distinct(), repair.audits, ["conv_id"], "left")
    found = join_null_safe(found, conversation_digests(repair.turns), ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(_table(spark, sf, "embeddings"))


def all_queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}
